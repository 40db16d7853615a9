"""Who wrote a user turn: one CASE over folded text, first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadmill.config import Config
from threadmill.functions import patterns as P
from threadmill.functions import text as X

MINE = ("authored", "own_voice")
LABELS = ("authored", "own_voice", "pasted", "quiz", "suggestion")


def turn_label(folded: Column, n: Column, cfg: Config | None = None) -> Column:
    """The label of a turn. ``folded`` is its folded text, ``n`` its word count; null text gives null."""
    cfg = cfg or Config()
    own = X.has(F.substring(folded, 1, P.OWN_VOICE_HEAD), f"({P.any_of(P.OWN_VOICE, cfg.extra_own_voice_preambles)})")
    third = X.has(folded, f"({P.any_of(P.THIRD_PARTY, cfg.extra_paste_markers)})")
    links = F.aggregate(F.regexp_extract_all(folded, F.lit(P.URL), 0), F.lit(0), lambda a, u: a + F.length(u))
    quiz = X.has(folded, P.OPTION_PICK) | X.has(folded, P.OPTION_BLOCK)
    trimmed = F.regexp_replace(folded, r"\A\s+|\s+\z", "")
    fragment = X.has(folded, P.BULLET) | trimmed.contains("\n")
    chip = X.has(folded, P.CHIP_VERB) | (fragment & X.has(folded, P.SECOND_PERSON) & ~trimmed.endswith("?"))
    return (
        F.when(folded.isNull(), None)
        .when((n >= P.LONG_TURN_WORDS) & own, "own_voice")
        .when(third | (X.count(folded, P.TIMESTAMP) >= 3), "pasted")
        .when((links > 0) & (links / F.greatest(F.length(folded), F.lit(1)) > P.URL_SHARE), "pasted")
        .when(quiz, "quiz")
        .when((n <= P.CHIP_MAX_WORDS) & ~X.has(folded, P.FIRST_PERSON) & chip, "suggestion")
        .when(n < P.LONG_TURN_WORDS, "authored")
        .when(X.voice_score(folded, n) >= P.AUTHORED_FLOOR, "authored")
        .otherwise("pasted")
    )


def school_patterns(body: Column, cfg: Config | None = None) -> dict[str, Column]:
    """Which of the patterns of coursework folded user texts, joined by line breaks, match."""
    cfg = cfg or Config()
    return {
        "third": X.has(body, f"({P.any_of(P.THIRD_PARTY, cfg.extra_paste_markers)})"),
        "school": X.has(body, P.SCHOOL),
        "marker": X.has(body, f"({P.any_of(P.COURSEWORK, cfg.extra_coursework_markers)})"),
        "block": X.has(body, P.OPTION_BLOCK),
    }


def coursework(n_turns: Column, drills: Column) -> Column:
    """Whether a conversation is coursework, by the columns of ``school_patterns`` and by how many of its user turns drill."""
    drilled = (n_turns >= 4) & (drills >= 4) & (drills / F.greatest(n_turns, F.lit(1)) >= 0.30)
    third, school, marker, block = (F.coalesce(F.col(c), F.lit(False)) for c in ("third", "school", "marker", "block"))
    return F.coalesce((third & school) | marker | (drilled & (block | school)), F.lit(False))


def is_drill(folded: Column) -> Column:
    return X.has(folded, P.OPTION_PICK) | X.has(folded, P.OPTION_BLOCK) | X.has(folded, P.DRILL)
