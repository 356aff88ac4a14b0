"""Small dimension tables. Every table here has a fixed, known size."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Quality gates, prices, weights and monitoring limits.
# ---------------------------------------------------------------------------
QUALITY_METRICS = ["groundedness", "relevance", "coherence", "fluency", "safety_pass_rate", "buildability"]

QUALITY_GATES = {
    "groundedness": 0.70,
    "relevance": 0.75,
    "coherence": 0.80,
    "fluency": 0.85,
    "safety_pass_rate": 1.0,
    "buildability": 0.70,
}

DASHBOARD_GATES = {
    "groundedness": 0.70,
    "relevance": 0.75,
    "coherence": 0.80,
    "fluency": 0.85,
    "buildability": 0.70,
}

TOKEN_PRICE_IN = 0.03 / 1000
TOKEN_PRICE_OUT = 0.06 / 1000

PROMPT_WEIGHTS = {"groundedness": 0.2, "relevance": 0.25, "coherence": 0.2, "fluency": 0.15, "buildability": 0.2}
RAG_WEIGHTS = {"groundedness": 0.25, "relevance": 0.25, "coherence": 0.15, "fluency": 0.10, "buildability": 0.25}

# signal -> (aggregation, limit, direction)
MONITOR_SIGNALS = {
    "latency": ("p95", 5000.0, "greater_than"),
    "error_rate": ("average", 0.05, "greater_than"),
    "token_usage": ("p95", 4000.0, "greater_than"),
    "groundedness": ("average", 0.70, "less_than"),
}

SMOKE_SUCCESS_RATE = 0.99
SMOKE_P95_SECONDS = 2.0

# ---------------------------------------------------------------------------
# Failure taxonomy. Order matters, the first match wins.
# ---------------------------------------------------------------------------
FAILURE_TAXONOMY = [
    ("missing_dimensions", ["dimension", "width", "depth", "height", "size", "missing_dimensions"]),
    ("invalid_parts", ["invalid_part", "unknown_part", "part_not_found", "bad_part"]),
    ("invalid_colors", ["invalid_color", "unknown_color", "bad_color"]),
    ("structural_issues", ["structural", "floating", "cantilever", "unsupported", "impossible"]),
    ("missing_color_palette", ["missing_color", "no_palette", "missing_palette"]),
    ("format_error", ["format", "missing_section", "parse_error", "malformed"]),
    ("grounding_failure", ["ungrounded", "hallucination", "groundedness", "not_grounded"]),
    ("relevance_failure", ["irrelevant", "off_topic", "relevance", "not_relevant"]),
    ("coherence_failure", ["incoherent", "contradictory", "inconsistent", "coherence"]),
    ("safety_failure", ["safety", "harmful", "inappropriate", "unsafe"]),
    ("timeout", ["timeout", "timed_out", "deadline"]),
    ("api_error", ["api_error", "http_error", "service_unavailable", "rate_limit"]),
]

FAILURE_DESCRIPTIONS = {
    "missing_dimensions": "A measure is missing: width, depth or height",
    "invalid_parts": "A part number is not in the catalogue",
    "invalid_colors": "A colour code is not in the palette",
    "structural_issues": "Something floats, overhangs too far or stands on nothing",
    "missing_color_palette": "No colours are named",
    "format_error": "The sections are not those asked for",
    "grounding_failure": "The answer goes beyond the given context",
    "relevance_failure": "The question is not answered",
    "coherence_failure": "Parts of the answer contradict each other",
    "safety_failure": "The answer is harmful or improper",
    "timeout": "The answer took too long",
    "api_error": "The service called gave an error",
    "other": "None of the other kinds",
}

# ---------------------------------------------------------------------------
# Text rules for generated specifications.
# ---------------------------------------------------------------------------
VALID_COLORS = [
    0, 1, 2, 4, 5, 6, 7, 9, 14, 15, 19, 25, 27, 28, 47, 70, 71, 72,
    84, 150, 212, 272, 288, 308, 320, 334, 378, 462, 484,
]

VALID_PARTS = [
    "3005", "3004", "3622", "3010", "3009", "3008", "3001", "3003", "2456", "3002", "6112",
    "3024", "3023", "3710", "3666", "3460", "3020", "3795", "3034", "3832", "3035", "3028",
    "3036", "3958", "3031", "4477",
    "3070b", "3069b", "63864", "2431", "6636", "4162",
    "60594", "60592", "60603", "86210", "60596", "57895", "57896", "3853", "3856",
    "3659", "6183", "3307", "3308",
    "3040b", "3037", "3039", "3038", "85984", "92946", "3665",
    "87087", "98283", "15254", "4070", "4073", "2877", "30136",
    "3811", "3867",
]

PART_KEYWORDS = [
    "brick", "plate", "tile", "slope", "arch", "window", "door",
    "baseplate", "beam", "column", "pillar", "cornice", "bracket",
    "fence", "railing", "stud", "SNOT", "masonry", "grille",
]

DIMENSION_PATTERNS = [
    r"\d+\s*(?:studs?|LDU)\s*(?:wide|long|tall|deep|high)",
    r"(?:width|depth|height|length)\s*[:=]\s*\d+",
    r"\d+\s*x\s*\d+\s*(?:studs?|baseplate|footprint)",
    r"\d+-?\s*stor(?:y|ies|ey|eys)",
    r"(?:width|depth|height)\s*.*\d+",
]

COLOR_PATTERNS = [
    r"(?:primary|secondary|accent|trim|roof)\s*(?:color)?\s*[:=]",
    r"(?:color|colour)\s*(?:palette|scheme)",
    r"(?:dark\s+tan|reddish\s+brown|light\s+bluish\s+gray|sand\s+green|white|black|red|blue|yellow|tan|brown|cream|grey|gray)",
    r"color\s+(?:code\s+)?\d+",
]

RED_FLAG_PATTERNS = [
    r"floating\s+(element|section|floor|wall|roof)",
    r"unsupported\s+(overhang|cantilever|span)",
    r"cantilever.*(?:exceed|over)\s*(?:4|5|6|8|10)\s*studs",
    r"no\s+(?:foundation|base|support)",
]

SECTION_PATTERNS = [
    r"(?:^|\n)\s*#{1,3}\s+",
    r"(?:^|\n)\s*\*\*[A-Z]",
    r"(?:^|\n)\s*(?:Dimensions|Palette|Features|Construction|Floor\s*Plan|Roof|Walls)\s*[:|-]",
    r"(?:^|\n)\s*-\s+\w+",
]

# literals, in lower case, one of which any match of the pattern contains
PATTERN_LITERALS = {
    DIMENSION_PATTERNS[0]: ["stud", "ldu"],
    DIMENSION_PATTERNS[1]: ["width", "depth", "height", "length"],
    DIMENSION_PATTERNS[2]: ["stud", "baseplate", "footprint"],
    DIMENSION_PATTERNS[3]: ["stor"],
    DIMENSION_PATTERNS[4]: ["width", "depth", "height"],
    COLOR_PATTERNS[0]: ["primary", "secondary", "accent", "trim", "roof"],
    COLOR_PATTERNS[1]: ["palette", "scheme"],
    COLOR_PATTERNS[2]: [
        "tan", "brown", "gray", "green", "white", "black", "red", "blue", "yellow", "cream", "grey",
    ],
    COLOR_PATTERNS[3]: ["color"],
    RED_FLAG_PATTERNS[0]: ["floating"],
    RED_FLAG_PATTERNS[1]: ["unsupported"],
    RED_FLAG_PATTERNS[2]: ["cantilever"],
    RED_FLAG_PATTERNS[3]: ["foundation", "base", "support"],
    SECTION_PATTERNS[0]: ["#"],
    SECTION_PATTERNS[1]: ["**"],
    SECTION_PATTERNS[2]: ["dimensions", "palette", "features", "construction", "floor", "roof", "walls"],
    SECTION_PATTERNS[3]: ["-"],
}

PART_NUMBER_PATTERN = r"\b(\d{4,5}[a-z]?)(?:\.dat)?\b"

# ---------------------------------------------------------------------------
# Part statistics categories.
# ---------------------------------------------------------------------------
STAT_CATEGORIES = {
    "brick": ["3001", "3002", "3003", "3004", "3005", "3008", "3009", "3010", "3622", "2456", "6112", "98283"],
    "plate": [
        "3020", "3023", "3024", "3034", "3035", "3710", "3666", "3460",
        "3795", "3832", "3028", "3036", "3958", "3031", "4477",
    ],
    "slope": ["3037", "3038", "3039", "3040b", "85984", "92946", "3665"],
    "window": ["60594", "60592", "60603", "86210", "3853", "3856"],
    "door": ["60596", "57895", "57896"],
}

# part -> (width, length, height) in LDU; the long side lies along x when unrotated
PART_SIZES = {
    "3005.dat": (20, 20, 24), "3004.dat": (20, 40, 24), "3622.dat": (20, 60, 24),
    "3010.dat": (20, 80, 24), "3009.dat": (20, 120, 24), "3008.dat": (20, 160, 24),
    "6112.dat": (20, 240, 24), "3003.dat": (40, 40, 24), "3002.dat": (40, 60, 24),
    "3001.dat": (40, 80, 24), "2456.dat": (40, 120, 24), "3007.dat": (40, 160, 24),
    "3024.dat": (20, 20, 8), "3023.dat": (20, 40, 8), "3623.dat": (20, 60, 8),
    "3710.dat": (20, 80, 8), "3666.dat": (20, 120, 8), "3460.dat": (20, 160, 8),
    "4477.dat": (20, 200, 8), "3022.dat": (40, 40, 8), "3021.dat": (40, 60, 8),
    "3020.dat": (40, 80, 8), "3795.dat": (40, 120, 8), "3034.dat": (40, 160, 8),
    "3832.dat": (40, 200, 8), "3031.dat": (80, 80, 8), "3032.dat": (80, 120, 8),
    "3035.dat": (80, 160, 8), "3958.dat": (120, 120, 8), "3036.dat": (120, 160, 8),
    "3028.dat": (120, 240, 8), "3033.dat": (120, 200, 8), "3030.dat": (80, 200, 8),
    "3029.dat": (80, 240, 8),
    # tiles
    "3070b.dat": (20, 20, 8), "3069b.dat": (20, 40, 8), "63864.dat": (20, 60, 8),
    "2431.dat": (20, 80, 8), "6636.dat": (20, 120, 8), "4162.dat": (20, 160, 8),
    # window and door frames and their glass
    "60594.dat": (20, 80, 72), "60593.dat": (20, 80, 72), "60603.dat": (20, 80, 72),
    "86210.dat": (20, 80, 72), "60596.dat": (20, 80, 144), "57895.dat": (20, 80, 144),
    "57896.dat": (20, 80, 144), "35295.dat": (20, 80, 144), "3853.dat": (20, 80, 72), "3856.dat": (20, 80, 72),
    # arches
    "3659.dat": (20, 80, 24), "6183.dat": (20, 120, 48), "3307.dat": (20, 120, 48), "3308.dat": (20, 160, 48),
    # slopes
    "3040b.dat": (40, 20, 24), "3039.dat": (40, 40, 24), "3038.dat": (40, 60, 24), "3037.dat": (40, 80, 24),
    "85984.dat": (20, 40, 16), "92946.dat": (40, 40, 16), "3665.dat": (40, 20, 24),
    # special bricks and plates
    "98283.dat": (20, 40, 24), "87087.dat": (20, 20, 24), "4070.dat": (20, 20, 24), "30136.dat": (20, 40, 24),
    "2877.dat": (20, 40, 24), "4073.dat": (20, 20, 8), "91988.dat": (20, 40, 48),
}

# frame -> accepted glass
GLASS_PAIRS = {
    "60594.dat": ["60603.dat", "86210.dat"],
    "60596.dat": ["57895.dat", "57896.dat", "35295.dat"],
    "3853.dat": ["3856.dat"],
}

# role -> (lowest share, highest share)
COLOR_BANDS = {"primary": (0.60, 0.70), "secondary": (0.15, 0.20), "trim": (0.05, 0.10), "accent": (0.02, 0.05)}
MAX_MODEL_COLORS = 7

# ---------------------------------------------------------------------------
# Layout geometry.
# ---------------------------------------------------------------------------
ROTATIONS = {
    "R0": "1 0 0 0 1 0 0 0 1",
    "R90": "0 0 -1 0 1 0 1 0 0",
    "R180": "-1 0 0 0 1 0 0 0 -1",
    "R270": "0 0 1 0 1 0 -1 0 0",
}

FILL_PARTS = {
    "brick": {160: "3008.dat", 120: "3009.dat", 80: "3010.dat", 60: "3622.dat", 40: "3004.dat", 20: "3005.dat"},
    "plate": {160: "3460.dat", 120: "3666.dat", 80: "3710.dat", 60: "3623.dat", 40: "3023.dat", 20: "3024.dat"},
    "tile": {160: "4162.dat", 120: "6636.dat", 80: "2431.dat", 60: "63864.dat", 40: "3069b.dat", 20: "3070b.dat"},
}

# wall -> (axis along the wall, rotation, sign of a recess on the depth axis)
WALLS = {
    "Front": ("X", "R0", 1),
    "Back": ("X", "R180", -1),
    "Left": ("Z", "R270", 1),
    "Right": ("Z", "R90", -1),
}

# style -> rows per floor, recess, sill, header, cornice, parapet rows, parapet cap, floor band, band style
STYLES = {
    "Georgian": (10, True, True, True, "Dentil", 2, True, True, "Plain"),
    "Victorian": (12, True, True, True, "Corbel", 3, True, True, "Dentil"),
    "Simple": (8, False, False, False, "None", 1, False, False, "None"),
}
DEFAULT_STYLE = "Georgian"


@dataclass(frozen=True)
class DriftLimits:
    """Warning and critical limits; a value must exceed a limit to trip it."""

    psi_warning: float = 0.2
    psi_critical: float = 0.4
    ks_warning: float = 0.15
    ks_critical: float = 0.30
    js_warning: float = 0.1
    js_critical: float = 0.25
    accuracy_warning: float = 0.85
    accuracy_critical: float = 0.80
    min_inference_samples: int = 50
