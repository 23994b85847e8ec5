"""Fixed values of the venue rules: word lists, patterns and layouts that results depend on."""

# --- fixed values: categories by cuisine tag ---
CUISINES = {
    "Deli": ["deli", "delicatessen", "sandwich"],
    "Chinese": ["chinese", "cantonese", "sichuan", "szechuan", "dim_sum", "hong_kong", "taiwanese", "dumpling"],
    "Japanese": ["japanese", "ramen", "udon", "izakaya", "katsu"],
    "Sushi": ["sushi"],
    "Korean": ["korean"],
    "Asian": ["asian", "pan_asian", "thai", "vietnamese", "malaysian", "indonesian", "filipino", "singaporean", "burmese", "chinese", "japanese", "korean", "sushi", "ramen", "noodle"],
    "Indian": ["indian", "pakistani", "bangladeshi", "nepalese", "sri_lankan", "curry", "balti", "punjabi"],
    "Halal": ["halal"],
    "Pizza": ["pizza"],
    "Italian": ["italian", "pasta", "italian_pizza"],
    "Tacos": ["tacos", "taco"],
    "Mexican": ["mexican", "tex-mex", "tex_mex", "tacos", "taco", "burrito"],
    "Spanish": ["spanish", "tapas", "catalan", "basque"],
    "Burger": ["burger"],
    "American": ["american", "diner", "southern", "hot_dog"],
    "Greek": ["greek", "cypriot", "gyros", "souvlaki"],
    "French": ["french", "crepe", "bistro", "brasserie"],
    "BBQ": ["bbq", "barbecue", "smokehouse"],
    "Steak": ["steak_house", "steak", "steakhouse", "grill"],
    "Bakery": ["bakery", "pastry", "cake"],
    "Breakfast": ["breakfast", "brunch", "coffee_shop"],
    "Donuts": ["donut", "doughnut", "donuts", "doughnuts"],
    "Bagels": ["bagel", "bagels"],
    "Ice cream": ["ice_cream", "gelato", "frozen_yogurt", "frozen_yoghurt", "dessert"],
    "Seafood": ["seafood", "fish_and_chips", "fish", "oyster", "fish_chips"],
    "Thai": ["thai", "isan", "northern_thai", "southern_thai", "thai_street_food"],
    "Western": ["western", "international", "european", "fusion", "british", "australian", "german"],
}
# --- fixed values: categories by venue name ---
NAME_PATTERNS = {
    "Deli": r"\bdeli\b|delicatessen",
    "Chinese": r"chinese|dim sum|wok\b|szechuan|sichuan",
    "Japanese": r"japanese|ramen|izakaya|yakitori",
    "Sushi": r"sushi",
    "Korean": r"korean",
    "Indian": r"indian|tandoor|curry|masala|balti|biryani",
    "Halal": r"halal",
    "Pizza": r"pizz",
    "Italian": r"trattoria|osteria|ristorante|italian|pasta",
    "Tacos": r"taco|taquer",
    "Mexican": r"mexican|burrito|cantina",
    "Spanish": r"tapas|spanish",
    "Burger": r"burger",
    "American": r"diner|american",
    "Greek": r"greek|souvlaki|gyro",
    "Food truck": r"food truck|street food",
    "French": r"bistro|brasserie|french|creperie",
    "BBQ": r"bbq|barbecue|smokehouse",
    "Steak": r"steak",
    "Bakery": r"bakery|bakehouse|patisserie|boulangerie",
    "Breakfast": r"breakfast|brunch",
    "Donuts": r"donut|doughnut",
    "Bagels": r"bagel|beigel",
    "Ice cream": r"ice cream|gelat|creamery",
    "Seafood": r"seafood|fish|oyster|chippy|lobster",
}
#: Category of a venue without any other.
DEFAULT_CATEGORY = {"cafe": "Cafe", "bar": "Bar", "fast_food": "Takeaway", "food_court": "Food court", "biergarten": "Pub"}
WESTERN = ["Burger", "Pizza", "American", "Italian", "Mexican", "Tacos", "Steak", "BBQ", "French", "Spanish", "Greek", "Bagels", "Donuts", "Breakfast", "Pub", "Western", "Deli"]

# --- fixed values: map selection ---
FOOD_AMENITIES = ["restaurant", "cafe", "fast_food", "pub", "ice_cream", "food_court", "biergarten", "food_truck"]
FOOD_SHOPS = ["bakery", "pastry", "deli", "ice_cream"]
CLOSED_TAGS = ["disused", "abandoned", "closed", "demolished"]
CLOSED_NAME = r"\bclosed\b"
CLOSED_NOTE = r"permanently closed|closed down|closed permanently|ceased trading"

# --- fixed values: register business types ---
BUSINESS_TAGS = {1: {"amenity": "restaurant"}, 7844: {"amenity": "fast_food"}, 7843: {"amenity": "pub"}, 7846: {"amenity": "fast_food", "street_vendor": "yes"}, 4613: {}}
RETAIL_TYPE = 4613
RETAIL_CATEGORIES = ["Bakery", "Deli", "Ice cream", "Donuts", "Bagels"]
AUTHORITY_ALIASES = {"City of London Corporation": "City of London", "Kingston-Upon-Thames": "Kingston upon Thames", "Richmond-Upon-Thames": "Richmond upon Thames"}
REGISTER_NOISE = r"\b(the|ltd|limited|restaurant|cafe|café|bar|kitchen|london|and|&)\b"

# --- fixed values: tags of catalogue leaves ---
LEAF_TAGS = {
    "bar": {"amenity": "bar", "food": "yes"}, "pub": {"amenity": "pub"}, "gastropub": {"amenity": "pub"}, "cafe": {"amenity": "cafe"},
    "coffee_shop": {"amenity": "cafe"}, "bakery": {"shop": "bakery"}, "food_truck": {"amenity": "fast_food", "street_vendor": "yes"},
    "fast_food_restaurant": {"amenity": "fast_food"}, "ice_cream_shop": {"amenity": "ice_cream"}, "donut_shop": {"cuisine": "donut"},
    "bagel_shop": {"cuisine": "bagel"}, "deli": {"shop": "deli"}, "steakhouse": {"cuisine": "steak_house"},
    "breakfast_and_brunch_restaurant": {"cuisine": "breakfast"}, "barbecue_restaurant": {"cuisine": "bbq"},
    "sushi_restaurant": {"cuisine": "sushi"}, "seafood_restaurant": {"cuisine": "seafood"}, "halal_restaurant": {"diet:halal": "yes"},
}

# --- fixed values: web addresses that are not a venue's own site ---
OTHER_SITE_LABELS = [
    "facebook", "fb", "instagram", "tiktok", "twitter", "linktr", "deliveroo", "ubereats", "just-eat", "justeat", "opentable", "tripadvisor", "yelp", "timeout",
    "squaremeal", "designmynight", "resdiary", "sevenrooms", "foodhub", "hungryhouse", "wolt", "youtube", "threads", "snapchat", "beacons", "linkin", "whatsapp", "wa",
]
OTHER_SITE_HOSTS = ["x.com", "google.com", "google.co.uk", "maps.google.com", "maps.google.co.uk", "goo.gl", "maps.app.goo.gl", "g.page", "g.co", "bit.ly"]
COMPANY_LABELS = ["wetherspoon", "jdwetherspoon", "greeneking", "stonegategroup"]
SECOND_LEVELS = ["co", "org", "ac", "com"]

# --- fixed values: e-mail addresses ---
EMAIL = r"[A-Za-z0-9._%+'-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,4}\.[A-Za-z]{2,24}"
EMAIL_SYNTAX = r"^[a-z0-9!#$%&'*+/=?^_`{|}~-]+(?:\.[a-z0-9!#$%&'*+/=?^_`{|}~-]+)*@(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z]{2,24}$"
ESCAPE_DEBRIS = r"^(?:u003[ce]|x3[ce]|u0022|20)+"
JUNK_PARTS = ["example.", "example@", "yourname@", "name@", "email@", "user@", "sentry", "wixpress", "domain.com", "email.com", "yourdomain", "godaddy", "squarespace.com", "mysite", "sentry-next", "@2x", "wix.com"]
JUNK_ENDS = [".png", ".jpg", ".jpeg", ".gif", ".webp", ".svg", ".css", ".js"]
NOT_FOR_CONTACT = r"^(privacy|gdpr|dpo|data|legal|investor|ir@|careers|jobs|recruit|hr@|noreply|no-reply|donotreply|webmaster|abuse|unsubscribe|accounts|invoice|payable|complaints|safeguarding)"
LOW_PRIORITY = ["press", "media", "pr@", "marketing", "partnerships", "partner", "customer", "feedback", "support"]
FREE_MAIL = ["gmail.com", "googlemail.com", "hotmail.com", "hotmail.co.uk", "outlook.com", "live.com", "live.co.uk", "yahoo.com", "yahoo.co.uk", "icloud.com", "me.com", "btinternet.com", "aol.com", "protonmail.com", "proton.me", "sky.com", "virginmedia.com"]
ROLES = ["reservations", "bookings", "booking", "book", "reserve", "info", "hello", "contact", "enquir", "events", "office", "manager", "admin", "team", "sales", "orders", "catering"]
TYPO_DOMAINS = [
    "gamil.com", "gmial.com", "gmai.com", "gmail.co", "gmail.con", "gmaill.com", "gnail.com", "gmail.cm", "gmail.om", "gmal.com", "gmali.com", "gmeil.com", "hotmial.com", "hotmail.con", "hotmai.com",
    "hotamil.com", "hotmil.com", "hotmaill.com", "homail.com", "hotmail.co", "yaho.com", "yahooo.com", "yahoo.con", "yhoo.com", "outlok.com", "outloo.com", "iclod.com", "icoud.com", "windowlive.com",
]

# --- fixed values: page patterns ---
MAILTO = r"(?i)mailto:([^\"'?>\s]+)"
CLOUDFLARE = r'data-cfemail="([0-9a-fA-F]+)"'
DATA_URI = r"(?i)data:[a-z/+.-]{1,40};base64,[A-Za-z0-9+/=]{100,}"
HIDDEN_AT = r"(?i)[ \t]{0,3}(?:\[at\]|\(at\)|\{at\})[ \t]{0,3}|[ \t]{1,3}at[ \t]{1,3}(?=[a-z0-9-]{1,63}[ \t]{0,3}(?:\[dot\]|\(dot\)|\{dot\}|[ \t]dot[ \t]))"
HIDDEN_DOT = r"(?i)[ \t]{0,3}(?:\[dot\]|\(dot\)|\{dot\})[ \t]{0,3}|[ \t]{1,3}dot[ \t]{1,3}"
LINK = r"""(?is)<a\b[^>]*href=["']([^"'#]+)["'][^>]*>(.*?)</a>"""
CONTACT_HINT = r"(?i)contact|about|find.?us|enquir|get.?in.?touch|reserv|book|private|event|visit|location"
FALLBACK_PATHS = ["/contact", "/contact-us", "/contactus", "/contact.html", "/about", "/about-us", "/find-us", "/private-hire", "/events", "/info"]
CLOSED_PAGE = (
    r"(?iu)permanently closed|closed permanently|closed for good|now closed for good|has now closed|have now closed"
    r"|closed (?:its|our) doors (?:for the (?:last|final) time|for good|permanently)|ceased trading|no longer trading|closed down"
    r"|we are now closed\b(?! (?:on|for|until|today|tomorrow|this))|ปิดกิจการ|ปิดถาวร|ปิดให้บริการถาวร"
)
PARKED_PAGE = r"(?i)domain (?:is |may be )?for sale|buy this domain|this domain has expired|domain parking|parked free|is parked|hugedomains|sedo\.com|dan\.com/buy"
REDIRECT = r"""(?i)http-equiv=["']?refresh["']?[^>]*url=['"]?([^"'>\s]+)|(?:window|document)\.location(?:\.href)?\s*=\s*["']([^"']+)"""
DECLARED_LANGUAGE = r"""(?i)<html[^>]{0,300}?\blang=["']?([a-zA-Z-]{2,10})"""
ENGLISH_VERSION = r"""(?i)hreflang=["']?en|href=["'][^"']{0,200}(?:/en(?:-[a-z]{2})?/|[?&]lang=en)"""

# --- fixed values: names and domains ---
PERSON = r"(?i)^(mr|mrs|ms|miss|dr)\b\.?"
COMPANY_WORDS = r"(?i)\b(ltd|limited|plc|llp|t/a|ta|trading as|uk|the)\b"
PLACE_WORDS = r"(?i)\b(district|khet|amphoe|borough|county|city|province)\b"
GENERIC = [
    "cafe", "restaurant", "kitchen", "bar", "pub", "grill", "takeaway", "food", "foods", "pizza", "chicken", "fish", "chips", "coffee", "bakery", "express", "house", "shop",
    "store", "catering", "canteen", "club", "social", "sports", "school", "limited", "london",
]
DOMAIN_WORDS = [("restaurant", ["Restaurant"]), ("cafe", ["Cafe", "Breakfast"]), ("pub", ["Pub"]), ("bakery", ["Bakery"]), ("kitchen", [])]
DOMAIN_ENDS = [".co.uk", ".com", ".uk", ".london"]
INSTAGRAM_RESERVED = ["p", "reel", "reels", "explore", "stories", "tv", "accounts", "direct", "about", "developer"]
FACEBOOK_RESERVED = ["sharer", "sharer.php", "share", "dialog", "login", "events", "groups", "photo", "photo.php", "watch", "marketplace", "hashtag", "search", "help", "policies", "l.php", "plugins"]
CLOSED_STATUSES = ["closed", "parked", "dead"]

# --- fixed values: column layouts of the outputs ---
_RATED = ["name", "name_local", "district", "admin_district", "categories", "english", "english_priority", "english_score", "site_language", "why"]
_END = ["phone", "address", "postcode", "source", "osm_url"]
LAYOUTS = {
    "borough_emails": ["email", "name", "borough", "area", "categories", "website", "other_emails", "email_source", "source", "locations", "phone", "address", "postcode", "osm_url"],
    "borough_websites": ["website", "website_type", "name", "borough", "area", "categories", "email", "locations", *_END],
    "borough_social": ["social_url", "name", "borough", "area", "categories", "facebook", "instagram", "locations", *_END],
    "city_emails": ["email", *_RATED, "website", "other_emails", "email_source", "locations", *_END],
    "city_websites": ["website", "website_type", *_RATED, "email", "locations", *_END],
    "city_social": ["social_url", *_RATED, "facebook", "instagram", "locations", *_END],
    "city_master": [
        "name", "name_local", "district", "admin_district", "categories", "english", "english_score", "site_language", "why", "email", "other_emails", "email_check", "website",
        "website_type", "phone", "address", "postcode", "facebook", "instagram", "lat", "lon", "source", "osm_url", "merged", "partner_notes",
    ],
    "rejected": ["email", "reason", "name", "district"],
}
