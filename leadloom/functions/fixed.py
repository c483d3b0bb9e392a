"""They must equal the source domain's for right results, so they are stated plainly, in natural order.

Longer lists (city slugs, given names, words that are no names) are parameters of the operators that need them."""

# --- fixed values: folds of letters that Unicode decomposition doesn't cover, or that the domain folds its own way ---
FOLDS = {"ä": "a", "ö": "o", "å": "a", "õ": "o", "ü": "u", "š": "s", "ž": "z", "æ": "ae", "ø": "o", "ß": "ss", "þ": "th", "ð": "d"}

# --- fixed values: words of company names ---
LEGAL_FORMS = ("oy", "ab", "oyj", "ky", "tmi", "ry", "osk", "oyab", "ou", "as", "mtu", "fie", "tu")
DESCRIPTIVE_WORDS = ("ravintola", "ravintolat", "restaurant", "restaurants", "restoran", "resto", "kahvila", "baari", "bar", "bistro", "cafe", "kohvik", "toitlustus")
STREET_WORDS = {"katu": "katu", "gatan": "katu", "tie": "tie", "vagen": "tie", "tanav": "tanav", "tn": "tanav", "puiestee": "puiestee", "pst": "puiestee", "maantee": "maantee", "mnt": "maantee"}

# --- fixed values: business ids ---
FI_WEIGHTS = (7, 9, 10, 5, 8, 4, 2)
EE_KEYWORDS = ("registrikood", "reg. nr", "reg nr", "regnr", "reg-nr", "ariregistri kood", "ariregistrikood", "registry code", "registration number", "registration code", "company code")
EE_WINDOW = 50

# --- fixed values: addresses that never belong to a venue ---
EMAIL = r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,24}\b"
VENDOR_DOMAINS = (
    "example.com", "example.org", "example.net", "domain.com", "email.com", "sentry.io", "sentry-next.wixpress.com", "wixpress.com", "wix.com", "sentry.wixpress.com", "squarespace.com", "wordpress.com", "wordpress.org",
    "automattic.com", "webflow.com", "shopify.com", "godaddy.com", "cloudflare.com", "google.com", "googlemail.com", "gstatic.com", "schema.org", "w3.org", "facebook.com", "instagram.com", "youtube.com", "adobe.com",
    "typekit.com", "fontawesome.com", "jquery.com", "yourdomain.com", "yourcompany.com", "site.com", "test.com", "mailchimp.com", "list-manage.com", "cookiebot.com", "onetrust.com", "smartlook.com", "hotjar.com", "matomo.org",
)
PLACEHOLDER_DOMAINS = ("mysite.com", "example.com", "example.org", "example.net", "domain.com", "yourdomain.com", "yoursite.com", "sitename.com", "company.com", "yourcompany.com", "email.com", "test.com", "wixsite.com", "squarespace.com", "wordpress.com", "webflow.io")
REJECTED_LOCALS = ("email", "your", "youremail", "name", "user", "username", "someone", "noreply", "no-reply", "donotreply", "example")
SHARED_INBOXES = (
    "info", "contact", "kontakt", "yhteystiedot", "myynti", "sales", "booking", "bookings", "varaus", "varaukset", "reservations", "reserve", "hello", "hei", "tere", "office", "toimisto", "posti", "mail", "email", "admin",
    "asiakaspalvelu", "customerservice", "support", "tilaukset", "orders", "catering", "events", "tapahtumat", "uritused", "peod", "rekry", "recruitment", "jobs", "tyopaikat", "hr", "laskutus", "invoice", "invoices", "arve",
    "billing", "shop", "kauppa", "press", "media", "marketing", "markkinointi", "tietosuoja", "privacy", "gdpr",
)

# --- fixed values: roles and labels near a name ---
ROLES = {
    "ravintolapaallikko": "restaurant manager", "vuoropaallikko": "shift manager", "keittiopaallikko": "head chef", "myyntipaallikko": "sales manager", "toimitusjohtaja": "managing director", "omistaja": "owner",
    "yrittaja": "entrepreneur/owner", "hovimestari": "maitre d'", "keittiomestari": "executive chef", "tapahtumakoordinaattori": "events coordinator", "myyntipalvelu": "sales desk", "juhataja": "manager", "tegevjuht": "CEO",
    "omanik": "owner", "peakokk": "head chef", "juhatuse liige": "board member", "restoranijuht": "restaurant manager", "muugijuht": "sales manager", "restaurant manager": "restaurant manager", "general manager": "general manager",
    "head chef": "head chef", "owner": "owner", "managing director": "managing director", "sales manager": "sales manager", "events manager": "events manager", "event manager": "events manager", "ceo": "CEO",
    "founder": "founder", "data controller": "data controller", "rekisterinpitaja": "data controller", "vastuuhenkilo": "responsible person", "vastutav isik": "responsible person",
    "andmekaitsespetsialist": "data protection officer", "tietosuojavastaava": "data protection officer",
}
NAME_LABELS = (
    "yhteyshenkilo", "yhteystiedot", "rekisterinpitaja", "tietosuojaseloste", "kontaktisik", "kontakt", "contact", "person", "email", "e", "mail", "puh", "tel", "phone", "ravintola", "restaurant", "restoran", "oy", "ab", "ou",
    "as", "hei", "moi", "tere", "toimipiste", "osoite", "aadress", "vastutav", "isik", "andmekaitse", "juhatuse", "liige", "vastaava",
)

# --- fixed values: patterns of addresses and people in pages ---
MAILTO = r"(?i)mailto:([^\"'>\s?]+)"
HIDDEN_EMAIL = r"data-cfemail=[\"']([0-9a-fA-F]+)[\"']"
SPELT_EMAIL = (
    r"(?i)([A-Za-z0-9._%+\-]+)"
    r"(?:\s*[\[({]\s*(?:@|at|ät)\s*[\])}]\s*|\s+(?:at|ät|miuku|at-merkki)\s+|@)"
    r"([A-Za-z0-9.\-]+)"
    r"(?:\s*[\[({]\s*(?:\.|dot|piste|punkt)\s*[\])}]\s*|\s+(?:dot|piste|punkt)\s+|\.)"
    r"([A-Za-z]{2,24})\b"
)
_CAP, _LOW = "A-ZÄÖÅÕÜŠŽ", "a-zäöåõüšž"
PERSON = rf"(?<![\p{{L}}\p{{N}}_])[{_CAP}][{_LOW}]{{1,20}}(?:-[{_CAP}][{_LOW}]{{1,20}})?(?:\s+[{_CAP}][{_LOW}]{{1,20}}){{1,2}}(?![\p{{L}}\p{{N}}_])"

# --- a list of our own, by topic: words of web pages that are capitalised like names; callers pass their own instead ---
NOT_NAMES = (
    # navigation and forms
    "home", "menu", "page", "site", "website", "search", "login", "read", "next", "back", "open", "closed", "subscribe", "newsletter", "share", "follow", "welcome", "news", "blog", "gallery", "online",
    # contact blocks and places
    "address", "email", "phone", "hours", "team", "staff", "company", "group", "ltd", "finland", "suomi", "estonia", "eesti", "helsinki", "tallinn", "tampere", "turku", "tartu",
    # notices
    "privacy", "policy", "cookie", "cookies", "terms", "data", "consent", "rights", "tietosuoja", "andmekaitse", "privaatsus",
    # eating out
    "table", "booking", "reservation", "delivery", "takeaway", "catering", "lunch", "lounas", "dinner", "brunch", "breakfast", "buffet", "bar", "kitchen", "wine", "beer", "drinks", "chef", "hotel",
    "gift", "card", "voucher", "lahjakortti", "kinkekaart", "order", "shop", "christmas", "joulu", "summer", "winter", "weekend", "today", "happy",
    # services named beside people
    "facebook", "instagram", "linkedin", "tiktok", "youtube", "tripadvisor", "wolt", "foodora",
)

# --- fixed values: phrases and pieces that mark a text as no name ---
PROSE_PHRASES = (
    "privacy policy", "cookie policy", "data controller", "restaurant manager", "head chef", "general manager",
    "opening hours", "contact us", "about us", "group bookings", "private events", "gift card", "tietosuojaseloste",
    "ota yhteytta", "ravintola oy", "helsinki finland", "tallinn estonia", "all rights", "read more", "book table",
)
PROSE_PIECES = ("policy", "oy", "ltd", "restaurant", "ravintola")

# --- fixed values: kinds of pages, with priority, phrases of anchors and pieces of paths (folded) ---
PAGE_KINDS = (
    ("privacy", 1, ("tietosuojaseloste", "tietosuoja", "tietosuojakaytanto", "rekisteriseloste", "evasteet", "kayttoehdot", "privaatsuspoliitika", "privaatsustingimused", "privaatsus", "andmekaitse", "isikuandmete tootlemine", "kupsised", "privacy policy", "privacy", "cookie policy", "cookies", "terms", "terms and conditions", "data protection"),
     ("tietosuoja", "tietosuojaseloste", "rekisteriseloste", "evasteet", "kayttoehdot", "privaatsus", "privaatsuspoliitika", "andmekaitse", "kupsised", "privacy", "privacy-policy", "cookie-policy", "cookies", "terms", "gdpr")),
    ("events", 2, ("tilaisuudet", "yksityistilaisuudet", "ryhmavaraukset", "juhlat", "kokoustilat", "yritystilaisuudet", "peod", "uritused", "seminarid", "grupibroneeringud", "private events", "group bookings", "functions", "events", "private dining", "celebrations", "meetings"),
     ("tilaisuudet", "yksityistilaisuudet", "ryhmavaraukset", "juhlat", "kokoustilat", "peod", "uritused", "private-events", "group-bookings", "functions", "events", "private-dining")),
    ("careers", 3, ("avoimet tyopaikat", "tyopaikat", "rekry", "toopakkumised", "tookohad", "karjaar", "careers", "jobs", "work with us", "join us", "vacancies"),
     ("tyopaikat", "rekry", "avoimet-tyopaikat", "tookohad", "toopakkumised", "careers", "jobs", "vacancies")),
    ("contact", 5, ("yhteystiedot", "ota yhteytta", "yhteys", "kontakt", "kontaktid", "vota uhendust", "contact", "contact us", "find us"),
     ("yhteystiedot", "yhteys", "ota-yhteytta", "kontakt", "kontaktid", "contact", "contact-us")),
    ("about", 6, ("meista", "tietoa meista", "tarina", "meist", "meie lugu", "about", "about us", "our story", "team", "our team", "henkilokunta", "meeskond"),
     ("meista", "tarina", "meist", "about", "about-us", "our-story", "team", "henkilokunta", "meeskond")),
)
HOME_PRIORITY, OTHER_PRIORITY = 4, 9
SKIPPED_EXTENSIONS = r"(?i)\.(pdf|jpe?g|png|gif|svg|webp|zip|docx?|xlsx?|pptx?|mp4|mp3|ics|css|js)$"
SKIPPED_PATHS = r"(?i)/(wp-admin|wp-login|feed|comments|tag|author|cart|checkout|my-account|search|\?s=|wp-json)(/|$)"
CMS_MARKERS = (
    ("wordpress", r"(?i)/wp-content/|/wp-includes/|rel=[\"']https://api\.w\.org/|wp-json"),
    ("squarespace", r"(?i)squarespace\.com|static1\.squarespace|Squarespace\.afterBodyLoad|name=[\"']generator[\"'][^>]*Squarespace"),
    ("wix", r"(?i)wixstatic\.com|wixsite\.com|parastorage\.com|name=[\"']generator[\"'][^>]*Wix"),
    ("webflow", r"(?i)webflow\.com|assets\.website-files\.com|name=[\"']generator[\"'][^>]*Webflow"),
    ("shopify", r"(?i)cdn\.shopify\.com|Shopify\.theme"),
)

# --- fixed values: structured data: types of businesses by rank, keys that show a node's substance, links to maps ---
BUSINESS_TYPES = {"restaurant": 0, "bar": 1, "barorpub": 1, "cafeorcoffeeshop": 1, "foodestablishment": 2, "hotel": 3, "localbusiness": 4, "place": 5, "organization": 6, "nightclub": 9}
BUSINESS_KEYS = ("address", "telephone", "aggregateRating", "geo", "servesCuisine", "priceRange", "openingHours", "openingHoursSpecification", "description", "menu")
MAP_LINK = r"(?i)href=[\"'](https?://(?:www\.)?(?:google\.[a-z.]+/maps[^\"']*|maps\.google\.[a-z.]+[^\"']*))[\"']"

# --- fixed values: social networks ---
SOCIALS = (
    ("instagram", r"https?://(?:www\.)?instagram\.com/([A-Za-z0-9_.]+)/?"),
    ("facebook", r"https?://(?:www\.)?facebook\.com/([A-Za-z0-9_.\-]+)/?"),
    ("linkedin", r"https?://(?:[a-z]{2,3}\.)?linkedin\.com/(?:company|in)/([A-Za-z0-9_.\-]+)/?"),
)
SOCIAL_JUNK = ("sharer", "share", "tr", "plugins", "dialog", "profile.php", "pages", "people", "hashtag", "explore", "p", "reel", "sharer.php")

# --- fixed values: company registers ---
FI_TARGET_LINES = ("56101", "56102", "56301", "56302", "55101", "55102", "55201", "55901")
FI_SITUATIONS = (("bankruptcy", ("konkurssi", "bankruptcy", "konkurs")), ("liquidation", ("selvitystila", "liquidation", "likvidation")), ("restructuring", ("yrityssaneeraus", "saneeraus", "restructuring", "företagssanering")))
FI_EXCLUDED = ("bankruptcy", "liquidation")
OFFICER_RANKS = (("toimitusjohtaja", 0, "managing director"), ("puheenjohtaja", 1, "board chair"), ("varapuheenjohtaja", 2, "deputy chair"), ("jasen", 3, "board member"), ("varajasen", 4, "deputy board member"))
OFFICER_DATE, REGISTRATION_STAMP = r"\b[0-9]{2}\.[0-9]{2}\.[0-9]{4}\b", r"(?i)\(\s*rekister"
COMPANY_MARKS = r"(?i)\b(oy|oyj|ab|ky|ry|tmi|as|ou|oü)\b|&|y-tunnus"
AUDITOR_ROLES = ("tilintarkastaja", "paavastuullinen tilintarkastaja", "varatilintarkastaja")
NAME_PARTICLES = ("von", "van", "de", "af", "la", "le", "der", "den", "di")

# --- fixed values: pieces of keys that name fields of a person record, best first, of lists that hold people, and of lists
# that hold none ---
CODE_KEYS = ("ariregistri_kood", "registrikood", "reg_kood", "kood", "registry_code")
GIVEN_NAME_KEYS = ("eesnimi", "first_name", "given_name")
SURNAME_KEYS = ("nimi_arinimi", "perekonnanimi", "last_name", "surname")
PERSON_NAME_KEYS = ("isiku_nimi", "person_name", "nimi_arinimi", "nimi", "name")
PERSON_ROLE_KEYS = ("isiku_roll_tekstina", "roll_tekstina", "isiku_roll", "roll", "role", "ametikoht")
ENDED_KEYS = ("kehtivuse_lopp", "end_date", "lopp_kpv", "loppemise")
PERSON_LIST_KEYS = ("isik", "person", "kaardile", "kanne", "esindus")
OTHER_LIST_KEYS = ("esindusoigus", "normaalregulatsioon", "eritingimus", "hooneyhistu")
