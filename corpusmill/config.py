"""Profiles and thresholds. Constants under "fixed values" are those that results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# Characters that cleaning deletes or replaces.
NIQQUD = "[\u0591-\u05C7]"
ZERO_WIDTH = "[\u200b-\u200f\u202a-\u202e\ufeff]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"
HEBREW = "[\u0590-\u05FF]"
PUNCTUATION = {"\u05BE": "-", "\u05F3": "'", "\u05F4": '"'}

# Scrub patterns in the order they are applied, with their placeholders.
SCRUB_RULES = (
    (r"(?U)\b\d{9}\b", "[מספר_זהות]"),
    (r"(?U)\b\d{3}-\d{3}-\d{3}\b", "[מספר_זהות]"),
    (r"(?U)\b\+972[- ]?\d[- ]?\d{3}[- ]?\d{4}\b", "[טלפון]"),
    (r"(?U)\b0[5]\d[- ]?\d{3}[- ]?\d{4}\b", "[טלפון]"),
    (r"(?U)\b0[2-489][- ]?\d{7}\b", "[טלפון]"),
    (r"(?U)\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b", "[אימייל]"),
    (r"(?U)\b\d{4}[- ]?\d{4}[- ]?\d{4}[- ]?\d{4}\b", "[מספר_כרטיס]"),
)
#: Opt-in repairs: the international prefix without a word before it, and landlines before nine-digit ids.
STRICT_SCRUB_RULES = (
    (r"(?U)(?<![\w+])\+972[- ]?\d{1,2}[- ]?\d{3}[- ]?\d{4}\b", "[טלפון]"),
    (r"(?U)\b0(?:5\d|[2-489])[- ]?\d{3}[- ]?\d{4}\b", "[טלפון]"),
    *SCRUB_RULES,
)
#: What every rule without an at sign needs, of both tables: nine digits with single separators at most.
SCRUB_DIGITS = r"(?U)\d(?:[- ]?\d){8}"
NAME_PLACEHOLDER = "[שם]"

# Boilerplate of court documents.
BOILERPLATE = (
    r"(?mdU)^[-_=]{3,}$",
    r"(?mdU)^\s*עמוד \d+ מתוך \d+\s*$",
    r"(?mdU)^\s*\d+\s*$",
    r"(?sU)בבית (?:המשפט|הדין).*?(?:בשבתו|בהרכב)",
    r"(?U)(?:הוגש|נחתם) (?:ביום|בתאריך) [\d.]+",
    r"(?U)(?:המזכירות|מזכירות בית) ת(?:שלח|מציא)",
)
#: Words of which a text holds one if the pattern matches in it.
BOILERPLATE_WORDS = {BOILERPLATE[1]: ("עמוד ",), BOILERPLATE[3]: ("בבית ",), BOILERPLATE[4]: ("הוגש ", "נחתם "), BOILERPLATE[5]: ("מזכירות",)}


@dataclass(frozen=True)
class FilterConfig:
    """Thresholds of the quality filters, and the script that a text should be written in.

    `script` is the class of wanted letters, `letters` that of all letters the share is taken of.
    """

    min_words: int = 100
    min_alpha_ratio: float = 0.4
    min_script_ratio: float = 0.5
    max_word_repetition: float = 0.5
    max_duplicate_lines: float = 0.3
    max_short_lines: float = 0.80
    short_line: int = 30
    max_boilerplate: float = 0.4
    script: str = HEBREW
    letters: str = "[a-zA-Z\u0590-\u05FF\u0600-\u06FF]"
    script_name: str = "hebrew_ratio"


HEBREW_PROFILE = FilterConfig()
#: For the supplied tables: the same thresholds, Latin letters with accents as the wanted script.
LATIN_PROFILE = FilterConfig(script="[a-zA-Z\u00C0-\u024F]", letters="[a-zA-Z\u00C0-\u024F\u0590-\u05FF\u0600-\u06FF]", script_name="latin_ratio")


@dataclass(frozen=True)
class FormatConfig:
    eval_ratio: float = 0.02
    upsample: dict[str, int] = field(default_factory=lambda: {"court": 1, "kolzchut": 5, "wikisource_laws": 5, "wikisource": 5})
    shuffle_seed: int = 42


@dataclass(frozen=True)
class QaConfig:
    """Documents wanted of each source, least words, and text lengths of prompts and of the helper's view."""

    targets: dict[str, int] = field(default_factory=lambda: {"wikisource": 2000, "kolzchut": 5347, "court": 1000})
    min_words: int = 200
    prompt_chars: int = 8000
    view_chars: int = 6000
    min_answer: int = 20
    seed: int = 42
