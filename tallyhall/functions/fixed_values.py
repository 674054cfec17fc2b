"""Values fixed by the published code lists and file layouts this library reads."""

# Half-open department-code bands [low, high) and their agency.
FIRST_BAND = "Legislative, Judicial, Executive"  # codes starting with 0 or shorter than 4
AGENCY_BANDS = [
    (1000, 2500, "Business, Consumer Services, and Housing"),
    (2500, 3000, "Transportation"),
    (3000, 3890, "Natural Resources"),
    (3890, 4000, "Environmental Protection"),
    (4000, 5210, "Health and Human Services"),
    (5210, 6000, "Corrections and Rehabilitation"),
    (6000, 7000, "Education"),
    (7000, 7500, "Labor and Workforce Development"),
    (7500, 8000, "Government Operations"),
    (8000, None, "General Government"),
]

# Census place class codes.
PLACE_CLASSES = {
    "M2": "A military or other defense installation entirely within a place",
    "C1": "An active incorporated place that does not serve as a county subdivision equivalent",
    "U1": "A census designated place with an official federally recognized name",
    "U2": "A census designated place without an official federally recognized name",
}

# Lines of the organisation manual that carry no entity.
SKIP_LINES = [
    r"^\s*$",
    r"REVISED(\s+)(\w+)(\s+)(\d+)",
    r"(\s*)DEPARTMENT(\s+)OF(\s+)FINANCE(\s*)",
    r"(\s*)UNIFORM(\s+)CODES(\s+)MANUAL(\s*)",
    r"(\s*)ORGANIZATION(\s+)CODES(\s*)",
    r"(\s*)BY(\s+)STRUCTURE(\s*)",
    r"(\s*)A(_+)(\s+)B(_+)(\s+)1(_+)(\s*)",
    r"^(\s*)(\d+)(\s*)$",
]
# Upper-case text that every match of the phrases above contains.
SKIP_HINTS = ["REVISED", "DEPARTMENT", "UNIFORM", "ORGANIZATION", "STRUCTURE", "A_"]
ENTITY_LINE = r"^( *)(\d+)\s+(.+)$"
INDENT_STEP = 5
LEVELS = ["a", "b", "l1", "l2", "l3"]

# Unit types an organisation name is not filed under.
UNIT_TYPES = [
    "Office of the Secretary (?:for|of)?",
    "Commission (?:on|for)?",
    "Board of Governors (?:for|of)?",
    "Board (?:of|on|for)?",
    "Agency (?:on|for)?",
    r"(?:Department|Dept\.) of",
    "Commission (?:on|for)?",
    "Committee (?:on|for)?",
    "Bureau of",
    "Council on",
    "Policy Council on",
    "Institute of",
    "Office (?:for|of)?",
    "Secretary (?:for|of)?",
    "",
]
UNIT_PREFIX = r"(?:California\s+)?(?:Governor's\s+)?(?:State\s+|St\.\s+)?(?:Intergovernmental\s+)?"
UNIT_SUFFIX = r"(?:\s+the)?"
FILED_AS_IS = "Governor's Office"
COMMISSION_ALIAS = (("Milton Marks", "Little Hoover"), "Little Hoover Commission")

# Patterns over raw entity names.
BARE_NAME = r"^(.+?)(?:(?:\s*\(.*\)\s*|\s*[-–]+\s*[A-Z/ ]+)*)$"
PARENTHETICAL = r"\((.+?)\)"
RESTRICTED_USE = "[A-Z/]+ USE ONLY"
MOVED_OR_RENUMBERED = "moved to|renum.? to"
TECHNICAL_CODES_FROM = 9000

# Tile pyramid and earth constants.
MERCATOR_LAT_LIMIT = 85.051129
LNGLAT_EPSILON = 1e-11
TILE_EPSILON = 1e-14
EARTH_RADIUS_M = 6371010.0  # mean radius, used for areas on the sphere
MERCATOR_RADIUS_M = 6378137.0  # spherical Mercator
