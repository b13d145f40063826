"""Fixed values.

Everything here is part of the specified behaviour: changing a value changes
results.  All of them are defaults of parameters, so callers can pass their own.
"""

from __future__ import annotations

# --- Table columns ---------------------------------------------------------

# A text column and the English column that gives its meaning.
COLUMN_PAIRS = [
    ("instruction", "instruction_en"),
    ("input", "input_en"),
    ("output", "output_en"),
]

RAW_COLUMNS = ["instruction", "input", "output", "instruction_en", "input_en", "output_en"]

# What a prepared table must hold to be valid.
PREPARED_REQUIRED = [
    "prompt",
    "task_type",
    "output_improved",
    "instruction_improved",
    "instruction_en",
]

# What each stage needs before it can start.
PREPARE_INPUTS = ["instruction_improved", "input_improved", "output_improved", "instruction_en"]
SCORE_INPUTS = ["task_type", "output_improved"]

# --- Skip rule -------------------------------------------------------------

MIN_TEXT_CHARS = 5

# --- Response validation ---------------------------------------------------

# Openings that show a model talks about its answer instead of giving it.
PREAMBLE_MARKERS = [
    "her er",
    "forbedret tekst:",
    "endringer:",
    "jeg har",
    "teksten er",
    "original:",
    "###",
    "bedre:",
    "resultat:",
]
MIN_RESPONSE_CHARS = 10
MIN_LINE_CHARS = 30
MIN_WORD_OVERLAP = 0.3
MAX_GROWTH = 3
GROWTH_SLACK = 50

# --- Task types ------------------------------------------------------------

# Tried in this order; the first label with a keyword inside the text wins.
TASK_KEYWORDS = {
    "classification": ["classify", "identify", "which", "categorize", "determine", "label"],
    "extraction": ["extract", "list", "find", "name", "enumerate", "mention"],
    "generation": ["write", "generate", "create", "compose", "draft", "produce"],
    "rewriting": ["rewrite", "paraphrase", "summarize", "simplify", "rephrase", "translate"],
    "qa": ["what", "how", "why", "explain", "describe", "define"],
    "creative": ["story", "poem", "imagine", "invent", "fiction", "creative"],
}
OTHER_TASK = "other"

# --- Rewards ---------------------------------------------------------------

SIMILARITY_FLOOR = 0.5
SIMILARITY_SPAN = 0.45

LANGUAGE_ALPHABET = "æøåÆØÅ"
LANGUAGE_BASE = 0.5
LANGUAGE_DENSITY = 0.02

LENGTH_FULL = (0.7, 1.5)
LENGTH_HALF = (0.3, 3.0)

VERIFIABLE_TASKS = ["classification", "extraction", "qa"]

REWARD_WEIGHTS = {"semantic": 2.0, "language": 1.0, "length": 0.5, "accuracy": 1.5}

# --- Generation ------------------------------------------------------------

REWRITE_BATCH_SIZE = 8
ANSWER_BATCH_SIZE = 4

# --- Text ------------------------------------------------------------------

# Unicode whitespace: the 29 code points that strip and word splitting remove.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
