"""Lookup dictionaries.

Order is semantics: every matcher in this package takes the *first* hit in
list order, so each dictionary is an ordered list of pairs, never a set.

The first block holds FIXED VALUES that must equal the behaviour being
reproduced (canonical company names, city aliases, coordinates, sector
keywords, signal words, extraction patterns). They are stated as plain text,
in their natural order, and are not derived from anything.

The second block holds fixture dictionaries for the generated test tables
(whose names are ``Customer#000000001`` / ``NATION_7`` and never hit the
fixed dictionaries). They are built from a rule, not listed.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reproduced behaviour exactly)
# ---------------------------------------------------------------------------

# Canonical company names for the similarity match (78 entries, one repeat).
CANONICAL_COMPANIES: list[str] = [
    "Infosys", "TCS", "Wipro", "HCL Technologies", "Tech Mahindra", "Cognizant",
    "Capgemini", "Accenture India", "LTIMindtree", "Mphasis", "Hexaware",
    "Persistent Systems", "Zensar Technologies", "Flipkart", "Swiggy", "Zomato",
    "Paytm", "Ola", "PhonePe", "Meesho", "Razorpay", "CRED", "Groww", "Zerodha",
    "Freshworks", "Zoho", "MakeMyTrip", "Nykaa", "Byju's", "Unacademy", "upGrad",
    "PolicyBazaar", "BigBasket", "Delhivery", "Amazon India", "Google India",
    "Microsoft India", "IBM India", "SAP India", "Oracle India", "Salesforce India",
    "Adobe India", "Uber India", "IndiGo", "Air India", "HDFC Bank", "ICICI Bank",
    "Reliance Industries", "Adani Enterprises", "Tata Consultancy Services",
    "Netflix India", "Atlassian", "Block", "Intel", "Cyient", "UST Global",
    "Hero MotoCorp", "OYO Rooms", "ITC Limited", "Coal India", "Torrent Pharma",
    "HCL Technologies", "Bajaj Auto", "Ashok Leyland", "BHEL", "Apollo Hospitals",
    "TVS Motors", "Info Edge", "Jio", "Zepto", "Dunzo", "Cars24", "Lenskart",
    "Urban Company", "boAt Lifestyle", "Mamaearth", "Naukri", "Quikr",
]

# Similarity cutoff (inclusive) for the canonical match.
COMPANY_MATCH_CUTOFF = 72

# City alias -> canonical city; the first alias contained in the text wins.
CITY_ALIASES: list[tuple[str, str]] = [
    ("bangalore", "Bengaluru"), ("bengaluru", "Bengaluru"), ("bombay", "Mumbai"), ("mumbai", "Mumbai"),
    ("delhi", "Delhi"), ("new delhi", "Delhi"), ("ncr", "Delhi"), ("gurgaon", "Gurugram"), ("gurugram", "Gurugram"),
    ("noida", "Noida"), ("hyderabad", "Hyderabad"), ("hyd", "Hyderabad"), ("chennai", "Chennai"),
    ("madras", "Chennai"), ("kolkata", "Kolkata"), ("calcutta", "Kolkata"), ("pune", "Pune"),
    ("ahmedabad", "Ahmedabad"), ("amdavad", "Ahmedabad"), ("jaipur", "Jaipur"), ("kochi", "Kochi"),
    ("cochin", "Kochi"), ("indore", "Indore"), ("nagpur", "Nagpur"), ("surat", "Surat"),
    ("chandigarh", "Chandigarh"), ("lucknow", "Lucknow"), ("bhopal", "Bhopal"), ("coimbatore", "Coimbatore"),
    ("vadodara", "Vadodara"), ("baroda", "Vadodara"), ("visakhapatnam", "Visakhapatnam"), ("vizag", "Visakhapatnam"),
    ("patna", "Patna"), ("ludhiana", "Ludhiana"), ("mysore", "Mysuru"), ("mysuru", "Mysuru"),
    ("thiruvananthapuram", "Thiruvananthapuram"), ("trivandrum", "Thiruvananthapuram"),
    ("bhubaneswar", "Bhubaneswar"), ("dehradun", "Dehradun"), ("nashik", "Nashik"), ("rajkot", "Rajkot"),
    ("madurai", "Madurai"), ("ranchi", "Ranchi"), ("guwahati", "Guwahati"), ("jodhpur", "Jodhpur"),
    ("vijayawada", "Vijayawada"), ("faridabad", "Faridabad"), ("ghaziabad", "Ghaziabad"),
    ("hubli", "Hubballi"), ("hubballi", "Hubballi"), ("mangalore", "Mangaluru"), ("mangaluru", "Mangaluru"),
    ("udaipur", "Udaipur"), ("aurangabad", "Aurangabad"), ("thane", "Thane"), ("kota", "Kota"),
    ("kozhikode", "Kozhikode"), ("calicut", "Kozhikode"), ("warangal", "Warangal"), ("raipur", "Raipur"),
    ("varanasi", "Varanasi"), ("agra", "Agra"), ("amritsar", "Amritsar"), ("jabalpur", "Jabalpur"),
    ("meerut", "Meerut"), ("navi-mumbai", "Navi Mumbai"), ("navi mumbai", "Navi Mumbai"),
    ("tiruchirappalli", "Tiruchirappalli"), ("trichy", "Tiruchirappalli"), ("guntur", "Guntur"),
]

# Canonical city -> (lat, lng); anything else gets DEFAULT_COORDS.
CITY_COORDS: list[tuple[str, float, float]] = [
    ("Bengaluru", 12.9716, 77.5946), ("Mumbai", 19.0760, 72.8777), ("Hyderabad", 17.3850, 78.4867),
    ("Chennai", 13.0827, 80.2707), ("Delhi", 28.6139, 77.2090), ("Gurugram", 28.4595, 77.0266),
    ("Noida", 28.5355, 77.3910), ("Pune", 18.5204, 73.8567), ("Kolkata", 22.5726, 88.3639),
    ("Ahmedabad", 23.0225, 72.5714), ("Jaipur", 26.9124, 75.7873), ("Kochi", 9.9312, 76.2673),
    ("Indore", 22.7196, 75.8577), ("Nagpur", 21.1458, 79.0882), ("Surat", 21.1702, 72.8311),
    ("Chandigarh", 30.7333, 76.7794), ("Lucknow", 26.8467, 80.9462), ("Bhopal", 23.2599, 77.4126),
    ("Coimbatore", 11.0168, 76.9558), ("Vadodara", 22.3072, 73.1812), ("Visakhapatnam", 17.6868, 83.2185),
    ("Patna", 25.5941, 85.1376), ("Ludhiana", 30.9010, 75.8573), ("Mysuru", 12.2958, 76.6394),
    ("Thiruvananthapuram", 8.5241, 76.9366), ("Bhubaneswar", 20.2961, 85.8245),
    ("Dehradun", 30.3165, 78.0322), ("Nashik", 19.9975, 73.7898), ("Rajkot", 22.3039, 70.8022),
    ("Madurai", 9.9252, 78.1198), ("Ranchi", 23.3441, 85.3096), ("Guwahati", 26.1445, 91.7362),
    ("Jodhpur", 26.2389, 73.0243), ("Vijayawada", 16.5062, 80.6480), ("Faridabad", 28.4089, 77.3178),
    ("Ghaziabad", 28.6692, 77.4538), ("Hubballi", 15.3647, 75.1240), ("Mangaluru", 12.9141, 74.8560),
    ("Udaipur", 24.5854, 73.7125), ("Aurangabad", 19.8762, 75.3433), ("Thane", 19.2183, 72.9781),
    ("Kota", 25.2138, 75.8648), ("Kozhikode", 11.2588, 75.7804), ("Warangal", 17.9689, 79.5941),
    ("Raipur", 21.2514, 81.6296), ("Varanasi", 25.3176, 82.9739), ("Agra", 27.1767, 78.0081),
    ("Amritsar", 31.6340, 74.8723), ("Jabalpur", 23.1815, 79.9864), ("Meerut", 28.9845, 77.7064),
    ("Navi Mumbai", 19.0330, 73.0297), ("Tiruchirappalli", 10.7905, 78.7047), ("Guntur", 16.3067, 80.4365),
]
DEFAULT_COORDS = (20.5937, 78.9629)

# Sector -> keywords for company-level classification; first sector with any hit wins.
SECTOR_KEYWORDS: list[tuple[str, list[str]]] = [
    ("IT Services", ["infosys", "wipro", "tcs", "hcl", "tech mahindra", "cognizant", "capgemini",
                     "accenture", "ltimindtree", "mphasis", "hexaware", "persistent", "zensar",
                     "ust", "niit", "mastech", "kpit"]),
    ("SaaS/Product", ["freshworks", "zoho", "browserstack", "chargebee", "postman", "hasura",
                      "druva", "icertis", "pubmatic", "the math company"]),
    ("Fintech", ["paytm", "razorpay", "phonepe", "cred", "groww", "zerodha", "policybazaar",
                 "bankbazaar", "slice", "jupiter", "fi money", "navi", "freo", "lendingkart"]),
    ("E-Commerce", ["flipkart", "amazon", "meesho", "nykaa", "myntra", "snapdeal", "shopclues",
                    "limeroad", "firstcry", "purplle", "zivame"]),
    ("Food Tech", ["swiggy", "zomato", "dunzo", "bigbasket", "zepto", "blinkit", "juspay"]),
    ("EdTech", ["byju", "unacademy", "upgrad", "vedantu", "physicswallah", "toppr", "doubtnut",
                "simplilearn", "skill-lync", "testbook"]),
    ("Travel/Mobility", ["makemytrip", "ola", "uber", "indigo", "air india", "goibibo", "yatra",
                         "cleartrip", "rapido", "bounce", "vogo"]),
    ("Healthcare", ["apollo", "fortis", "narayana", "manipal", "1mg", "pharmeasy", "practo",
                    "mfine", "healthkart", "cult.fit"]),
    ("Media/Gaming", ["netflix", "hotstar", "zee", "sony", "times", "jio cinema", "dream11",
                      "mpl", "nazara", "games24x7"]),
    ("Banking/Finance", ["hdfc", "icici", "sbi", "axis", "kotak", "indusind", "yes bank", "bajaj finance"]),
    ("Manufacturing", ["tata motors", "mahindra", "hero", "bajaj", "tvs", "ashok leyland", "maruti",
                       "bhel", "l&t", "vedanta", "jsw", "tata steel"]),
    ("Infrastructure", ["adani", "reliance", "gmr", "gvk", "nhai", "irfc", "rites"]),
    ("FMCG", ["itc", "hindustan unilever", "dabur", "marico", "godrej", "emami", "patanjali"]),
    ("Real Estate", ["dlf", "sobha", "godrej properties", "brigade", "prestige", "oberoi realty"]),
    ("Logistics", ["delhivery", "ecom express", "xpressbees", "shadowfax", "bluedart", "fedex india"]),
    ("Consulting", ["mckinsey", "bcg", "bain", "deloitte", "pwc", "ey", "kpmg", "roland berger"]),
    ("Cloud/IT", ["google", "microsoft", "amazon web", "oracle", "sap", "salesforce", "adobe",
                  "servicenow", "workday", "vmware"]),
]
SECTOR_DEFAULT = "Other"
IT_SECTOR = "IT Services"

# Sector -> keywords for the company-register classification (name only).
REGISTER_SECTOR_KEYWORDS: list[tuple[str, list[str]]] = [
    ("Technology", ["tech", "software", "digital", "data", "cloud", "cyber",
                    "infosys", "systems", "solutions", "it ", "iot", "ai ",
                    "analytics", "platform", "saas", "fintech", "edtech",
                    "healthtech", "agritech", "proptech"]),
    ("Finance", ["bank", "finance", "financial", "invest", "insurance", "nbfc", "capital", "fund"]),
    ("Healthcare", ["health", "hospital", "pharma", "medical", "clinic", "diagnostics"]),
    ("Retail", ["retail", "ecommerce", "shop", "mart", "bazaar", "store"]),
    ("Manufacturing", ["manufactur", "industry", "industries", "factory", "product"]),
    ("Education", ["educat", "school", "college", "academy", "learning", "training"]),
    ("Real Estate", ["real estate", "realty", "builder", "construction", "infra"]),
    ("Media", ["media", "publish", "broadcast", "entertainment", "film"]),
]

# Register office code -> state; unknown codes fall back to the record's state name.
ROC_STATE: list[tuple[str, str]] = [
    ("RoC-Ahmedabad", "Gujarat"), ("RoC-Bangalore", "Karnataka"), ("RoC-Chandigarh", "Punjab/Haryana"),
    ("RoC-Chennai", "Tamil Nadu"), ("RoC-Coimbatore", "Tamil Nadu"), ("RoC-Delhi", "Delhi"),
    ("RoC-Ernakulam", "Kerala"), ("RoC-Gwalior", "Madhya Pradesh"), ("RoC-Hyderabad", "Telangana"),
    ("RoC-Jaipur", "Rajasthan"), ("RoC-Jammu", "Jammu & Kashmir"), ("RoC-Kanpur", "Uttar Pradesh"),
    ("RoC-Kolkata", "West Bengal"), ("RoC-Mumbai", "Maharashtra"), ("RoC-Patna", "Bihar"),
    ("RoC-Pune", "Maharashtra"), ("RoC-Shillong", "Meghalaya"), ("RoC-Shimla", "Himachal Pradesh"),
    ("RoC-Vijayawada", "Andhra Pradesh"), ("RoC-Cuttack", "Odisha"),
]

# State -> its major cities, in order (the first city receives the split remainder).
STATE_CITIES: list[tuple[str, list[str]]] = [
    ("Karnataka", ["Bengaluru", "Mysuru", "Hubli"]),
    ("Maharashtra", ["Mumbai", "Pune", "Nagpur", "Nashik"]),
    ("Telangana", ["Hyderabad", "Warangal", "Karimnagar"]),
    ("Tamil Nadu", ["Chennai", "Coimbatore", "Madurai"]),
    ("Delhi", ["New Delhi", "Noida", "Gurugram"]),
    ("West Bengal", ["Kolkata", "Howrah", "Asansol"]),
    ("Gujarat", ["Ahmedabad", "Surat", "Vadodara"]),
    ("Rajasthan", ["Jaipur", "Jodhpur", "Udaipur"]),
    ("Uttar Pradesh", ["Lucknow", "Noida", "Kanpur", "Agra"]),
    ("Haryana", ["Gurugram", "Faridabad", "Panipat"]),
    ("Punjab", ["Chandigarh", "Ludhiana", "Amritsar"]),
    ("Madhya Pradesh", ["Indore", "Bhopal", "Jabalpur"]),
    ("Andhra Pradesh", ["Visakhapatnam", "Vijayawada", "Guntur"]),
    ("Kerala", ["Kochi", "Thiruvananthapuram", "Kozhikode"]),
]

# Signal words: a text is "layoff" / "hiring" by the count of distinct words present.
LAYOFF_WORDS: list[str] = ["layoff", "lay off", "fired", "retrench", "cut", "let go",
                           "job loss", "pink slip", "downsizing", "workforce reduction"]
HIRING_WORDS: list[str] = ["hiring", "recruit", "job opening", "vacancy", "join us",
                           "we're hiring", "campus", "fresher", "lateral hire", "onboard"]

# Headcount patterns, tried in order, case-insensitive; group 1 is the number.
HEADCOUNT_PATTERNS: list[str] = [
    r"(\d[\d,]+)\s+(?:employees?|workers?|staff|jobs?|people)\s+(?:laid off|fired|cut|let go|retrenched)",
    r"(?:lay off|layoff|cut|fire|retrench)\s+(\d[\d,]+)\s+(?:employees?|workers?|staff|people)",
    r"(\d[\d,]+)\s*(?:-|to)\s*\d[\d,]+\s+(?:jobs?|positions?|roles?)",
    r"reduce\s+(?:workforce|headcount|staff)\s+by\s+(\d[\d,]+)",
    r"(\d+)\s*%\s+(?:of its|of the)?\s*(?:workforce|employees?)",
]

# Company patterns, tried in order, case-sensitive; group 1 is the name.
COMPANY_PATTERNS: list[str] = [
    r"([A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+){0,3})\s+(?:lays? off|has laid off|plans? to lay off)",
    r"([A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+){0,3})\s+(?:fires?|let go|retrenches?|cuts? \d)",
    r"([A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+){0,3})\s+(?:announces?|plans?)\s+(?:mass )?hiring",
    r"([A-Z][a-zA-Z]+(?:\s+[A-Z][a-zA-Z]+){0,3})\s+(?:to hire|is hiring|recruiting)",
]
COMPANY_STOP_WORDS: list[str] = ["The", "A", "An", "India", "New", "This"]

# Literal words each pattern above cannot match without (derived by reading
# the patterns' alternations); used only to skip hopeless regex scans.
HEADCOUNT_GUARDS: list[list[str]] = [
    ["laid off", "fired", "cut", "let go", "retrenched"],
    ["lay off", "layoff", "cut", "fire", "retrench"],
    ["job", "position", "role"],
    ["reduce"],
    ["%"],
]
COMPANY_GUARDS: list[list[str]] = [
    ["lay", "laid off"],
    ["fire", "let go", "retrench", "cut"],
    ["hiring"],
    ["to hire", "is hiring", "recruiting"],
]

# Known companies looked up (case-insensitively) before the patterns, in this priority order.
KNOWN_COMPANIES: list[str] = [
    "Infosys", "TCS", "Wipro", "HCL", "Tech Mahindra", "Cognizant",
    "Accenture", "IBM", "Capgemini", "LTIMindtree", "Mphasis",
    "Hexaware", "Persistent", "NIIT Technologies", "Zensar",
    "Byju's", "Paytm", "Swiggy", "Zomato", "PhonePe", "Meesho",
    "Ola", "Uber India", "Nykaa", "Flipkart", "Amazon India",
    "Google India", "Microsoft India", "Meta India", "Apple India",
    "Razorpay", "CRED", "Groww", "Zerodha", "Freshworks",
    "Zoho", "MakeMyTrip", "IndiGo", "Air India", "HDFC Bank",
]

# City names looked for in free text (the earliest mention wins, then the longest name).
MENTION_CITIES: list[str] = [
    "bengaluru", "bangalore", "mumbai", "hyderabad", "chennai",
    "delhi", "new delhi", "pune", "kolkata", "ahmedabad",
    "gurgaon", "gurugram", "noida", "jaipur", "kochi", "cochin",
    "indore", "nagpur", "surat", "chandigarh", "lucknow", "bhopal",
    "coimbatore", "vadodara", "visakhapatnam", "vizag", "patna",
    "ludhiana", "mysore", "mysuru", "thiruvananthapuram", "trivandrum",
    "bhubaneswar", "dehradun", "nashik", "rajkot", "madurai", "ranchi",
    "guwahati", "jodhpur", "vijayawada", "faridabad", "ghaziabad",
    "hubli", "hubballi", "mangalore", "mangaluru", "udaipur",
    "aurangabad", "thane", "kota", "kozhikode", "warangal", "raipur",
    "varanasi", "agra", "amritsar", "jabalpur", "meerut", "guntur",
]

# Signal score bands: (exclusive lower bound on headcount, magnitude); below all -> 0.4.
SCORE_BANDS: list[tuple[int, float]] = [(5000, 1.0), (1000, 0.8), (100, 0.6)]
SCORE_FLOOR = 0.4
SIGNAL_TYPES: list[str] = ["layoff", "hiring", "neutral"]

# Status thresholds on mean signal score.
STATUS_LAYOFF_BELOW = -0.3
STATUS_HIRING_ABOVE = 0.3

# Register values treated as "no sector".
EMPTY_SECTORS: list[str] = ["", "nan", "Other"]

# Trend: number of snapshots kept and the output scale.
HISTORY_POINTS = 8
TREND_MIN, TREND_MAX, TREND_SPAN = 5, 100, 95

# Bronze chunking: records per landed file.
RECORDS_PER_CHUNK = 500

# ---------------------------------------------------------------------------
# Fixture dictionaries for the generated tables (built from rules)
# ---------------------------------------------------------------------------


def fixture_city_aliases(n_nations: int = 25) -> list[tuple[str, str]]:
    """``nation_<k>`` -> ``District <k>`` in key order.

    Key order reproduces the shadowed-alias trap of the fixed map (an early
    short alias that is a substring of later ones): ``nation_1`` precedes
    ``nation_10`` .. ``nation_19``, so those all resolve to District 1.
    """
    return [(f"nation_{k}", f"District {k}") for k in range(n_nations)]


def fixture_canonical_names(step: int = 97, upto: int = 20000) -> list[str]:
    """Short canonical forms ``Customer#<k>`` for every ``step``-th key.

    Near-miss spellings of the long ``Customer#00000xxxx`` names: they land
    on both sides of the cutoff and produce score ties, so they exercise the
    cutoff and the first-best-wins rule.
    """
    return [f"Customer#{k}" for k in range(0, upto, step)]


def fixture_sector_keywords() -> list[tuple[str, list[str]]]:
    """Market-segment words of the customer table as sector keywords.

    ``mobile`` sits before ``Machinery``'s ``machin`` and is a substring of
    AUTOMOBILE only; ``hold`` under Finance is a substring of HOUSEHOLD and
    shadows the later Household entry (the accidental-hit trap).
    """
    return [
        ("Mobility", ["mobile"]),
        ("Finance", ["hold", "fund"]),
        ("Construction", ["build"]),
        ("Furniture", ["furn"]),
        ("Household", ["house"]),
        ("Machinery", ["machin"]),
    ]


def fixture_roc_states(n_nations: int = 25) -> list[tuple[str, str]]:
    """``RoC-NATION_<k>`` -> ``Zone <k div 5>`` for even k; odd codes fall back to the state name."""
    return [(f"RoC-NATION_{k}", f"Zone {k // 5}") for k in range(0, n_nations, 2)]
