"""Fixed values of the domain.

These values must equal the ones used by the legacy system for results to
agree; they are stated here plainly, in their natural order.
"""

# ---------------------------------------------------------------------------
# Map types (id order = 1..7), name and abbreviation.
MAPTYPES = [
    (1, "Corner Record", "CR"),
    (2, "Highway Map", "HM"),
    (3, "Monument Map", "MM"),
    (4, "Parcel Map", "PM"),
    (5, "Record Map", "RM"),
    (6, "Survey", "RS"),
    (7, "Unrecorded Map", "UR"),
]

# Trs record sources (id, description, quality).
SOURCES = [
    (0, "Hollins full-section records", 10),
    (1, "Hollins subsection records", 40),
    (2, "Parsed full-section records", 40),
    (3, "Parsed subsection records", 50),
    (4, "Additional XLSX records", 40),
]
SOURCE_LEGACY_SECTION = 0
SOURCE_LEGACY_SUBSECTION = 1
SOURCE_PARSED_SECTION = 2
SOURCE_PARSED_SUBSECTION = 3
SOURCE_SHEET = 4

# Named quarter-quarter patterns (bits, name, rank), in the
# listed order that the greedy cover walks.  Bit 0 is NW/4 NW/4, rows run
# left to right, bit 15 is SE/4 SE/4.
SUBSEC_NAMES = [
    (0xFFFF, "1/1", 16),
    (0x00FF, "N/2", 8), (0xFF00, "S/2", 8),
    (0xCCCC, "E/2", 8), (0x3333, "W/2", 8),
    (0x00CC, "NE/4", 4), (0xCC00, "SE/4", 4),
    (0x3300, "SW/4", 4), (0x0033, "NW/4", 4),
    (0x000F, "N/2 N/2", 4), (0x00F0, "S/2 N/2", 4),
    (0x0F00, "N/2 S/2", 4), (0xF000, "S/2 S/2", 4),
    (0x8888, "E/2 E/2", 4), (0x4444, "W/2 E/2", 4),
    (0x2222, "E/2 W/2", 4), (0x1111, "W/2 W/2", 4),
    (0x000C, "N/2 NE/4", 2), (0x00C0, "S/2 NE/4", 2),
    (0x0088, "E/2 NE/4", 2), (0x0044, "W/2 NE/4", 2),
    (0x0C00, "N/2 SE/4", 2), (0xC000, "S/2 SE/4", 2),
    (0x8800, "E/2 SE/4", 2), (0x4400, "W/2 SE/4", 2),
    (0x0300, "N/2 SW/4", 2), (0x3000, "S/2 SW/4", 2),
    (0x2200, "E/2 SW/4", 2), (0x1100, "W/2 SW/4", 2),
    (0x0003, "N/2 NW/4", 2), (0x0030, "S/2 NW/4", 2),
    (0x0022, "E/2 NW/4", 2), (0x0011, "W/2 NW/4", 2),
    (0x0008, "NE/4 NE/4", 1), (0x0080, "SE/4 NE/4", 1),
    (0x0040, "SW/4 NE/4", 1), (0x0004, "NW/4 NE/4", 1),
    (0x0800, "NE/4 SE/4", 1), (0x8000, "SE/4 SE/4", 1),
    (0x4000, "SW/4 SE/4", 1), (0x0400, "NW/4 SE/4", 1),
    (0x0200, "NE/4 SW/4", 1), (0x2000, "SE/4 SW/4", 1),
    (0x1000, "SW/4 SW/4", 1), (0x0100, "NW/4 SW/4", 1),
    (0x0002, "NE/4 NW/4", 1), (0x0020, "SE/4 NW/4", 1),
    (0x0010, "SW/4 NW/4", 1), (0x0001, "NW/4 NW/4", 1),
]

# Masks of the algebraic subsection parser.  The right-hand
# (outer) term selects a quarter or half of the section; the left-hand
# (inner) term selects the same direction inside each quarter.
OUTER_MASKS = {"NE": 0x00CC, "SE": 0xCC00, "SW": 0x3300, "NW": 0x0033,
               "N": 0x00FF, "S": 0xFF00, "E": 0xCCCC, "W": 0x3333}
INNER_MASKS = {"NE": 0x0A0A, "SE": 0xA0A0, "SW": 0x5050, "NW": 0x0505,
               "N": 0x0F0F, "S": 0xF0F0, "E": 0xAAAA, "W": 0x5555}

# Legacy quarter-quarter numbers 1..16 (numbered back and
# forth from the north-east corner) and the bit each one stands for.
LEGACY_QQ_BITS = [0x0008, 0x0004, 0x0002, 0x0001, 0x0010, 0x0020, 0x0040, 0x0080,
                  0x0800, 0x0400, 0x0200, 0x0100, 0x1000, 0x2000, 0x4000, 0x8000]
# Inverse: legacy number of bit 0..15.
LEGACY_QQ_OF_BIT = [4, 3, 2, 1, 5, 6, 7, 8, 12, 11, 10, 9, 13, 14, 15, 16]

# Grid bounds accepted by the path validator.
TOWNSHIP_NORTH_MAX = 15
TOWNSHIP_SOUTH_MAX = 5
RANGE_EAST_MAX = 8
RANGE_WEST_MAX = 3

# Integer bounds of the trs table checks.
TRS_CHECKS = {"valid_tshp": (-5, 14), "valid_rng": (-3, 7),
              "valid_sec": (1, 36), "valid_subsec": (1, 65535)}

# Text patterns of the description parser.
SUBSEC_TOKEN = r"(?:(?:[NS][EW]/4|[NSEW]/2)\s*)?(?:[NS][EW]/4|[NSEW]/2)\s*S\d{1,2}"
TR_TOKEN = r"\d+[NS]\s*,\s*\d+[EW]"

# The literal section list replaced by FULL TOWNSHIP.
FULL_TOWNSHIP = ",".join(f"S{i}" for i in range(1, 37))

# Record maps whose narrow frames are certificates of correction.
RECORDED_TYPES = ("PM", "RM", "RS")
CC_MIN_WIDTH_HUNDREDTHS = 875   # 8.75 inches
DEFAULT_SCAN_DPI = 200           # replaces an unset (96 dpi) header
MAP_DPI = 160

# Named entities that the markup readers replace.
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "deg": "\u00b0",
            "frac14": "\u00bc", "frac12": "\u00bd", "frac34": "\u00be", "eacute": "\u00e9", "ntilde": "\u00f1",
            "ndash": "\u2013", "mdash": "\u2014"}

# Elements without content, which never open a level.
VOID_ELEMENTS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

# Elements whose end tag may be left out.
OPTIONAL_END = ("p", "li", "dt", "dd", "option", "thead", "tbody", "tfoot", "tr", "td", "th")

# Heading of a map record ("3 Parcel Map 120-121") and labels of its paragraphs.
HEADING = r"^(\d+)\s+(.*)\s+(\d+)(?:\D(\d+))?"
LABEL = r".+?: "

# Parts of file names, read from the last folder on.
BOOK_PART = r".*/(\d{3,})"
PAGE_PART = r".*/\d{3,}..(\d{3,})"
ABBREV_PART = r".*/\d{3,}(..)"
IMAGE_PART = r".*-(\d{3,})"
MAP_PART = r"^(\d{3,}\D{2}\d{3,})"
CC_FILE = r"^\d{4}-(or|doc)-\d{6,}-\d{3,}\.tif\z"

# A workbook's location text and the parser's qualifier and section split.
SHEET_TRS = r"(.* )?S(\d+) T?(\d+[NS]) R?(\d+[EW])"
QUALIFIER = r"^(\d+[NS]).*(\d+[EW])\z"          # case sensitive, greedy
SECTION_SPLIT = r"^(.*[24])\s*(S\d+)\z"          # case sensitive
