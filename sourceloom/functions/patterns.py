"""Patterns, word lists and maps that results depend on."""

# URL priority patterns and weights, in their order.
WEIGHTS = {"very_high": 15, "high": 10, "medium": 5, "low": -3}
EXCLUDED_SCORE = -999
VERY_HIGH = (
    "instruction", "how[-_]?to", "step[-_]?by[-_]?step", "guide", "procedure", "process", "apply", "application", "requirements?",
    "documents?[-_]?(?:need|require|list)", "fee[s]?(?:[-_]|$)", "payment", "eligibility", "faq", "frequently[-_]?asked", "help", "support",
    "নির্দেশনা", "আবেদন[-_]?পদ্ধতি", "প্রয়োজনীয়[-_]?কাগজপত্র", "ফি", "সাহায্য",
)
HIGH = (
    "download", "form", "template", "timeline", "processing[-_]?time", "delivery", "status", "track", "schedule", "appointment", "booking",
    "tutorial", "steps?", "checklist", "service", "portal", "online", "e[-_]?passport", "e[-_]?service", "citizen", "public",
    "ডাউনলোড", "ফরম", "সময়সীমা", "অবস্থা",
)
MEDIUM = (
    "about", "overview", "info", "contact", "office", "location", "branch", "center", "centre", "hotline", "helpline", "notice", "circular",
    "announcement", "যোগাযোগ", "অফিস", "শাখা", "নোটিশ",
)
LOW = ("archive", "history", "past", "old", "previous")
EXCLUDE = (
    "press[-_]?release", "news(?:[-_]|$)", "tender", "job", "career", "vacancy", "recruitment", "event", "gallery", "photo", "image", "video",
    "media", "blog", "article", "award", "achievement", "rti", "grievance", "complaint", "feedback", "survey", "login", "register(?:[-_]|$)",
    "signin", "signup", "logout", "password", "forgot", "reset", "verify[-_]?email", "activation", "print", "share", "social", "facebook",
    "twitter", "youtube", "sitemap", "rss", "feed", "api/", "ajax", "json", "xml", r"\.js$", r"\.css$", r"\.png$", r"\.jpg$", r"\.gif$", r"\.svg$",
    "সংবাদ", "প্রেস", "ছবি",
)

# Page types and what names them, in their order.
PAGE_TYPES = {
    "tutorial": "tutorial|guide|how[-_]?to|instruction|step[-_]?by[-_]?step",
    "procedure": "procedure|process|apply|application|steps?",
    "faq": "faq|frequently[-_]?asked|questions?|help",
    "requirements": "requirement|document|eligibility|criterion|criteria",
    "fees": "fees?|payment|charge|cost|price|tariff",
    "processing_time": "processing[-_]?time|duration|delivery|turnaround",
    "portal": "portal|login|register|account|dashboard",
    "office": "office|location|address|branch|center|centre",
    "contact": "contact|helpline|hotline|support|customer[-_]?service",
    "form": "form|download|template",
}

# Words that mark steps and instructions.
STEP_WORDS = ("ধাপ", "পর্যায়", "পদ্ধতি")
STEP_ADVERBS = ("প্রথমে", "এরপর", "অতঃপর", "শেষে")
BENGALI_ENDINGS = ("করুন", "যান", "দিন", "নিন")
BENGALI_ACTIONS = (
    ("আবেদন", "করুন"), ("পূরণ", "করুন"), ("জমা", "দিন"), ("সংগ্রহ", "করুন"), ("প্রদান", "করুন"), ("যাচাই", "করুন"), ("ক্লিক", "করুন"),
    ("নির্বাচন", "করুন"), ("আপলোড", "করুন"), ("ডাউনলোড", "করুন"),
)
ENGLISH_ACTIONS = (
    "apply", "submit", "visit", "collect", "pay", "fill", "upload", "click", "download", "select", "enter", "verify", "check", r"go\s+to",
    r"log\s*in", r"sign\s*in", "register", "create", "complete", "provide", "attach",
)

# Words of fee variants, most specific first; currencies.
FEE_VARIANTS = (
    ("super_express", (r"super[-\s]?express", r"সুপার\s*এক্সপ্রেস")),
    ("emergency", ("emergency", "urgent", "জরুরি", "তাৎক্ষণিক")),
    ("express", ("express", "এক্সপ্রেস")),
    ("regular", ("regular", "নিয়মিত", "সাধারণ")),
)
CURRENCY = "BDT|Taka|টাকা|TK"
MAX_AMOUNT = 10_000_000

# Document extensions and MIME types.
MIME_TYPES = {
    ".pdf": "application/pdf",
    ".doc": "application/msword",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".xls": "application/vnd.ms-excel",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".ppt": "application/vnd.ms-powerpoint",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
}
DOCUMENT_EXTENSIONS = tuple(MIME_TYPES)
BINARY_EXTENSIONS = (*DOCUMENT_EXTENSIONS, ".zip", ".rar")

# Services and agencies by host.
SERVICES = {
    "epassport.gov.bd": "svc.epassport", "nidw.gov.bd": "svc.nid", "services.nidw.gov.bd": "svc.nid", "passport.gov.bd": "svc.passport",
    "dip.gov.bd": "svc.passport", "visa.gov.bd": "svc.visa", "etaxnbr.gov.bd": "svc.etax", "nbr.gov.bd": "svc.nbr", "customs.gov.bd": "svc.customs",
    "bsp.brta.gov.bd": "svc.brta", "brta.gov.bd": "svc.brta", "bdpost.gov.bd": "svc.bdpost", "landadministration.gov.bd": "svc.land",
    "land.gov.bd": "svc.land", "teletalk.com.bd": "svc.teletalk", "bdris.gov.bd": "svc.bdris", "police.gov.bd": "svc.police",
}
AGENCY_NAMES = {
    "agency.dip": "Department of Immigration and Passports",
    "agency.bec": "Bangladesh Election Commission",
    "agency.nbr": "National Board of Revenue",
    "agency.brta": "Bangladesh Road Transport Authority",
    "agency.bpo": "Bangladesh Post Office",
    "agency.mol": "Ministry of Land",
    "agency.tt": "Teletalk Bangladesh Limited",
    "agency.bdris": "Office of Registrar General, Birth and Death Registration",
    "agency.bp": "Bangladesh Police",
}
AGENCIES = {
    "passport.gov.bd": "agency.dip", "www.epassport.gov.bd": "agency.dip", "epassport.gov.bd": "agency.dip", "dip.gov.bd": "agency.dip",
    "visa.gov.bd": "agency.dip", "nidw.gov.bd": "agency.bec", "services.nidw.gov.bd": "agency.bec", "etaxnbr.gov.bd": "agency.nbr",
    "nbr.gov.bd": "agency.nbr", "customs.gov.bd": "agency.nbr", "bsp.brta.gov.bd": "agency.brta", "brta.gov.bd": "agency.brta",
    "bdpost.gov.bd": "agency.bpo", "landadministration.gov.bd": "agency.mol", "land.gov.bd": "agency.mol", "teletalk.com.bd": "agency.tt",
    "bdris.gov.bd": "agency.bdris", "police.gov.bd": "agency.bp",
}


# Pages that have options of their own (host without www. and path).
OVERRIDES = {"epassport.gov.bd/instructions/passport-fees": {"only_main_content": False, "formats": ["markdown", "rawHtml"], "wait_ms": 5000, "bdt_for_tk": True}}

# Filter lists of the older crawler, over lower-cased URLs.
ARCHIVED_KEYWORDS = (
    "passport", "epassport", "e-passport", "immigration", "nid", "national id", "voter", "election", "birth", "death", "marriage", "registration", "certificate",
    "land", "property", "mutation", "khatian", "tax", "etax", "e-tax", "nbr", "income tax", "vat", "tin", "brta", "driving", "license", "vehicle", "motor",
    "police", "clearance", "verification", "apply", "application", "service", "e-service", "online", "fee", "requirement", "document", "process", "step", "how to",
    "eligibility", "faq", "instruction",
)
ARCHIVED_EXCLUDE = (
    r"/news\b", r"/press\b", "/press-release", "/pressrelease", r"/media\b", "/event", "/notice", "/notices", "/circular", "/notification", "/gazette", "/tender", "/procurement",
    "/career", "/job", "/vacancy", "/recruitment", "/gallery", "/photo", "/video", "/image", "/blog", "/article", "/archive", "/latest", "/recent", "/update",
    r"\.pdf$", r"\.doc$", r"\.docx$", r"\.xls$", r"\.xlsx$", r"\.zip$", r"\.rar$", r"\.exe$", r"\.apk$", "/(bn|en)/news", "/(bn|en)/notice", "/(bn|en)/notices",
)
ARCHIVED_INCLUDE = (
    "apply", "application", "instruction", "how-to", "eligibility", "requirement", "document", "fee", "charge", "cost", "price", "process", "step", "procedure",
    "service", "e-service", "online", "faq", "help", "guide", "form", "download",
)
