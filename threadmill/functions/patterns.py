"""Patterns and word lists. They run on folded text (``text.fold``), where every letter and digit beyond ASCII is ``_``;
so one pattern means the same in Java's, Python's and DuckDB's dialect."""

from __future__ import annotations

# The measurements below depend on these exact patterns, lists and thresholds.
CODE_FENCE = r"(?s)```.*?```"
WORD = r"\b[\w'-]+\b"
FIRST_PERSON = r"\b(i|i'm|im|i've|ive|i'd|i'll|my|me|myself|mine)\b"
SPOKEN_FILLER = (
    r"\b(like|yeah|yep|um|uh|okay|ok|you know|i mean|kinda|kind of|sorta|sort of|gonna|wanna|cuz|honestly|literally|basically|right|so|actually|just)\b"
)
OWN_VOICE = (
    r"voice\s+(note|memo|journal|recording)",
    r"audio\s+(note|memo|recording)",
    r"transcript\s+of\s+(a|my|this)\s+voice",
    r"synthesi[sz]e\s+(this|my)\s+(voice|memo)",
    r"(here|heres|here's|here.s)\s+(is\s+)?(the|a|my)\s+transcript",
    r"my\s+journal",
    r"i\s+voice\s+noted",
)
THIRD_PARTY = (
    r"skip to main content",
    r"skip to search",
    r"notifications total",
    r"you are provided the title and transcript",
    r"instagram followers",
    r"smartbook",
    r"mylab",
    r"brightspace",
    r"question content area",
    r"multiple (choice|select) question\.",
    r"select an answer and submit",
    r"time remaining",
    r"group starts",
    r"question\s+\d+\s+\(mandatory\)",
    r"question\s+\d+\s+options:",
    r"assignment sheet",
)
COURSEWORK = (
    r"smartbook",
    r"mylab",
    r"brightspace",
    r"question content area",
    r"multiple (choice|select) question\.",
    r"assignment sheet",
    r"question\s+\d+\s+\(mandatory\)",
    r"question\s+\d+\s+options:",
)
TIMESTAMP = r"\b\d{1,2}:\d{2}:\d{2}\b"
URL = r"https?://\S+"
OPTION_PICK = r"^\s*(\(?[a-eA-E]\)?|[0-9]{1,3}|true|false)([\s,]+and\s+|[\s,]+)?((\(?[a-eA-E]\)?|[0-9]{1,3})\s*)*[.)]?\s*$"
OPTION_BLOCK = r"(^|\n)\s*[a-eA-E][.)]\s+\S.*(\n\s*[a-eA-E][.)]\s+\S.*){2,}"
CHIP_VERB = (
    r"^\s*(?:[-*•]\s*)?(map|pressure-?test|stress-?test|simulate|formalize|translate this into|design (a|the)|identify (the|your)|"
    r"explore (the|your|how|why)|break down (your|the|how)|build (a|the|your)|turn this into)\b"
)
SECOND_PERSON = r"\byour\b|\byou\b"
BULLET = r"[•]|\n\s*[-*]\s"
DRILL = r"^\s*(solve|answer|do)\s+(this|these|it|the following|another)|^\s*another one\s*$|^\s*next (one|question)\s*$|^\s*same thing"
SCHOOL = (
    r"\b(exam|midterm|final|quiz|homework|professor|semester|syllabus|assignment|textbook|study guide|coursework|lecture|problem set|multiple choice)\b"
)
BRANCH_TITLE = r"^\s*branch\s*[·–—:>-]*\s*"
TERM = r"[a-z][a-z'-]{2,}"
STOP_WORDS = tuple(
    """
the a an and or but if then than that this these those there here it its it's
is are was were be been being am do does did doing have has had having i im
i'm ive i've me my myself we our us you your he she they them his her their
of in on at to for with from by as into about over after before under between
not no nor so too very just really can could would should will shall may might
must one two three what when where which who whom why how all any both each
few more most other some such only own same don't now up down out off
again further once because while during against above below yours like
get got go going make made say said know think want need thing things lot
""".split()
)
LONG_TURN_WORDS = 300
AUTHORED_FLOOR = 12.0
OWN_VOICE_HEAD = 220
URL_SHARE = 0.40
CHIP_MAX_WORDS = 70
TERM_CAP = 150
CONTENT_DAY_WORDS = 80
ECHO_RUN = 8
QUOTE_RUN = 7
MIN_SEGMENT = 20
TEXT_TYPES = ("text", "multimodal_text")
EXPECTED_DROPS = (
    "thoughts",
    "reasoning_recap",
    "user_editable_context",
    "code",
    "execution_output",
    "tether_browsing_display",
    "tether_quote",
    "system_error",
    "sonic_webpage",
    "computer_output",
    "app_pairing_content",
)
KNOWN_ROLES = ("user", "assistant", "system", "tool")
# End of the fixed values.


def any_of(parts: tuple[str, ...], extra: tuple[str, ...] = ()) -> str:
    """One pattern that matches where any part does. Extra fragments come from the configuration, empty ones are left out."""
    return "|".join([*parts, *(x for x in extra if x)])
