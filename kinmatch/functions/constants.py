"""Fixed values of the matching task: word lists, suffix patterns, thresholds. They are data, and must stay as they are."""

# Values of a whole field that mean "nothing".
NOISE_VALUES = ("null", "nan", "none", "n/a", "na", "n a", "not available", "not applicable", "unknown", "unspecified")

# Legal forms, in the order in which they are replaced; a text has no punctuation any more at this point.
LEGAL_FORMS = (
    (r"\bl\s*l\s*c\b", "llc"),
    (r"\bl\s*l\s*p\b", "llp"),
    (r"\bpvt\s*ltd\b", "private limited"),
    (r"\bprivate\s+ltd\b", "private limited"),
    (r"\bpvt\s*limited\b", "private limited"),
    (r"\bltd\b", "limited"),
    (r"\bcorp\b", "corporation"),
    (r"\binc\b", "incorporated"),
    (r"\bco\b", "company"),
    (r"\bp\s*c\b", "pc"),
    (r"\bdba\b", "dba"),
    (r"\bs\s*a\s*r\s*l\b", "sarl"),
    (r"\bs\s*a\s*s\s*u\b", "sasu"),
    (r"\bs\s*a\s*s\b", "sas"),
    (r"\be\s*u\s*r\s*l\b", "eurl"),
    (r"\bs\s*c\s*i\b", "sci"),
    (r"\bm\s+s\b", ""),
    (r"\bshree\b", "sri"),
    (r"\bshri\b", "sri"),
)

# The street words that are written out; "ct" becomes the state, as in the task's own table.
STREET_WORDS = {
    "rd": "road", "ave": "avenue", "blvd": "boulevard", "dr": "drive", "ln": "lane", "ct": "connecticut", "pl": "place", "cir": "circle",
    "pkwy": "parkway", "hwy": "highway", "sq": "square", "ter": "terrace", "trl": "trail", "expy": "expressway", "apt": "apartment", "ste": "suite", "bldg": "building",
}

# Name words that are no blocking keys.
NAME_STOP = (
    "the", "and", "company", "corporation", "limited", "private", "ltd", "pvt", "llc", "inc", "services", "management", "group", "solutions",
    "enterprises", "international", "holdings", "global", "technologies", "sarl", "sasu", "eurl", "association",
)

# Address words that are no blocking keys: the IDF index's list, and the integer-weight index's list.
ADDRESS_STOP = (
    "road", "street", "lane", "floor", "building", "near", "opposite", "behind", "beside", "plot", "shop", "flat", "apartment", "nagar", "colony",
    "india", "state", "city", "cross", "main", "sector", "delhi", "mumbai", "bengaluru", "hyderabad", "chennai", "kolkata",
)
ADDRESS_STOP_WIDE = (
    "the", "and", "road", "rd", "street", "st", "lane", "ln", "floor", "fl", "building", "bldg", "near", "opp", "opposite", "behind", "beside", "plot",
    "no", "hno", "dno", "door", "shop", "flat", "apartment", "nagar", "colony", "india", "delhi", "mumbai", "bengaluru", "hyderabad", "chennai",
    "kolkata", "state", "city", "west", "east", "north", "south", "cross", "main", "sector",
)

# Words that the rule matchers skip, in names and addresses alike.
RULE_STOP_V2 = (*NAME_STOP, "road", "street", "lane", "floor", "building", "near", "nagar", "colony", "plot", "sector", "india", "france", "north", "south", "east", "west", "main", "cross")
RULE_STOP_V3 = (*RULE_STOP_V2, "door", "shop", "flat", "apartment", "behind", "opposite", "opp", "hno", "dno", "new", "old")

# First words that the precision scrub skips.
SCRUB_STOP = ("the", "and", "inc", "llc", "ltd", "corp", "pvt")

# Thresholds of the ensemble and of the rescue by country; a country without its own takes DEFAULT_COUNTRY's.
THRESHOLDS = {"France": 0.82, "US": 0.85, "India": 0.82}
FAST_THRESHOLDS = {"France": 0.75, "US": 0.78, "India": 0.75}
DEFAULT_COUNTRY = "US"
BLEND, GATE, CLOSURE_FLOOR, RESCUE_FLOOR = (0.45, 0.35, 0.20), 0.20, 0.85, 0.45
