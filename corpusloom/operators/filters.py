"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import or_empty, question_key, strip, word_count

#: How a licence text begins, what it says, and address parts of pages without content.
LICENCE_PREFIXES = ("apache license", "mit license", "copyright (c)", "bsd license", "gnu general public", "mozilla public license", "terms and conditions")
LICENCE_PHRASES = (
    "apache.org/licenses/LICENSE-2.0",
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    "THIS SOFTWARE IS PROVIDED",
    "Redistribution and use in source and binary forms",
    "Permission is hereby granted, free of charge",
    "under the terms of the GNU",
    "Lesser General Public License",
    "Mozilla Public License",
    "creativecommons.org/licenses",
)
#: What must follow a phrase.
LICENCE_TAILS = {"THIS SOFTWARE IS PROVIDED": r"""\s+["']?AS[- ]IS"""}
BLOCKED_URL_PARTS = ("acknowledgement", "acknowledge", "third-party", "thirdparty", "open-source", "opensource", "legal", "license-notice")

LICENCE_TEXT = "(?is)(" + "|".join(p.replace(".", r"\.") + LICENCE_TAILS.get(p, "") for p in LICENCE_PHRASES) + ")"
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def is_noise(text: Column, url: Column | None = None, least_tokens: int = 60, tokens: Column | None = None) -> Column:
    """Too short, a blocked address, a licence, a list of links, or almost only code. ``tokens``: a count other than words."""
    bare = strip(text)
    noisy = (word_count(bare) if tokens is None else tokens) < least_tokens
    if url is not None:
        noisy |= F.lower(or_empty(url)).rlike("|".join(BLOCKED_URL_PARTS))
    low = F.lower(bare)
    for phrase in LICENCE_PREFIXES:
        noisy |= low.startswith(phrase)
    for phrase in LICENCE_PHRASES:  # plain searches; a pattern only where a phrase needs its tail
        found = F.contains(low, F.lit(phrase.lower()))
        noisy |= found & low.rlike("(?s)" + phrase.lower() + LICENCE_TAILS[phrase].lower()) if phrase in LICENCE_TAILS else found
    lines = F.split(bare, LINE_END)
    links = F.size(F.filter(lines, lambda x: x.rlike(r"^\s*- \[")))
    noisy |= F.contains(bare, F.lit("- [")) & (F.size(lines) > 5) & (links / F.size(lines) > 0.6)
    code = F.length(bare) - F.length(F.regexp_replace(bare, r"(?s)```.*?```", ""))
    return noisy | (F.contains(bare, F.lit("```")) & (code / F.greatest(F.length(bare), F.lit(1)) > 0.85))


def long_enough(question: Column, answer: Column, least_question: int = 12, least_answer: int = 8) -> Column:
    return (word_count(question) >= least_question) & (word_count(answer) >= least_answer)


def answer_in_question(question: Column, answer: Column) -> Column:
    a = question_key(answer)
    return (a != "") & F.contains(question_key(question), a)


def other_character_share(text: Column) -> Column:
    n = F.length(or_empty(text))
    return F.when(n > 0, F.length(F.regexp_replace(text, "[A-Za-z0-9 \t\n\r]", "")) / n).otherwise(0.0)


def unended_share(text: Column) -> Column:
    """Share of non-blank lines without a sentence mark at their end."""
    lines = F.filter(F.split(or_empty(text), "\n"), lambda x: F.trim(x) != "")
    return F.when(F.size(lines) > 0, F.size(F.filter(lines, lambda x: ~x.rlike(r"[.!?\"'][ \t\r]*$"))) / F.greatest(F.size(lines), F.lit(1))).otherwise(0.0)


def top_gram_share(rows: DataFrame, id_col: str, text_col: str, n: int = 3) -> DataFrame:
    """(id, share): how much of each text's n-word runs its most frequent one is; texts with fewer words have no row.

    A text's runs are sorted and counted inside its row, so nothing is shuffled.
    """
    words = F.split(F.lower(F.trim(F.regexp_replace(or_empty(F.col(text_col)), r"[ \t\n\x0B\f\r]+", " "))), " ")
    runs = F.sort_array(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " ")))

    def step(s, gram):
        again = F.when(s["gram"] == gram, s["again"] + 1).otherwise(1)
        return F.struct(gram.alias("gram"), again.alias("again"), F.greatest(s["most"], again).alias("most"))

    start = F.struct(F.lit(None).cast("string").alias("gram"), F.lit(0).alias("again"), F.lit(0).alias("most"))
    share = F.aggregate("runs", start, step, lambda s: s["most"]) / F.size("runs")
    return rows.select(F.col(id_col).alias("id"), words.alias("w")).where(F.size("w") >= n).select("id", runs.alias("runs")).select("id", share.alias("share"))


#: Filters by name, for lists of (name, limits) in a configuration.
SCORES = {"word_count": word_count, "other_characters": other_character_share, "unended_lines": unended_share}


def score_and_part(rows: DataFrame, text_col: str, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """The rows with every score and ``retained``: all scores within their limits, both ends included."""
    out = rows.withColumns({name: SCORES[name](F.col(text_col)) for name in limits})
    good = F.lit(True)
    for name, (low, high) in limits.items():
        good &= F.col(name).between(low, high)
    return out.withColumn("retained", good)
