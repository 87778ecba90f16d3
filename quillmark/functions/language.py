"""Scripts and languages of a text, by its characters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions.text import NWS, blank, chars_of, let, text_of

# The script classes of pack A, in the order that decides ties.
SCRIPTS = {
    "hangul": r"[\x{ac00}-\x{d7a3}]",
    "latin": r"[A-Za-z]",
    "cjk": r"[\x{4e00}-\x{9fff}\x{3040}-\x{30ff}]",
    "cyrillic": r"[\x{400}-\x{4ff}]",
    "arabic": r"[\x{600}-\x{6ff}]",
}

# The character classes of pack B.
HANGUL = r"[\x{ac00}-\x{d7a3}\x{1100}-\x{11ff}\x{3130}-\x{318f}]"
HAN = r"[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{f900}-\x{faff}]"
KANA = r"[\x{3040}-\x{309f}\x{30a0}-\x{30ff}\x{31f0}-\x{31ff}]"
LATIN = r"[A-Za-z\x{c0}-\x{24f}\x{1e00}-\x{1eff}]"
_VIETNAMESE = "ăâđêôơưàáảãạèéẻẽẹìíỉĩịòóỏõọùúủũụỳýỷỹỵ"
# In either case, so that texts need not be lower-cased; other characters are told by one comparison.
VIETNAMESE = f"[\\x{{c0}}-\\x{{1ef9}}&&[{_VIETNAMESE}{_VIETNAMESE.upper()}\\x{{1ea0}}-\\x{{1ef9}}]]"

_FOREIGN = "[" + "".join(SCRIPTS[n][1:-1] for n in ("hangul", "cjk", "cyrillic", "arabic")) + "]"
_EAST = "[" + (HANGUL + KANA + HAN).replace("[", "").replace("]", "") + "]"


def _ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def _none_of(c: Column, cls: str) -> Column:
    """No character of a class from U+0400 on; one look at most, and none at a text of ASCII alone.

    A class of many ranges is slow: the characters before are told by one comparison.
    """
    return _ascii(c) | ~c.rlike(rf"[\x{{400}}-\x{{ffff}}&&{cls}]")


def has_east(c: Column) -> Column:
    """Whether there is any Hangul, Kana or Han character."""
    return ~_none_of(c, _EAST)


def _www(c: Column) -> Column:
    return c.rlike(r"[Ww][Ww][Ww]\.")


def noisy(c: Column) -> Column:
    """Whether there is any mark of what :func:`strip_noise` takes."""
    return c.contains("`") | c.contains("://") | _www(c)


def scripts_in(c: Column) -> Column:
    """Names of the scripts present."""
    return F.array_compact(F.array(*[F.when(c.rlike(p), name) for name, p in SCRIPTS.items()]))


def n_scripts(c: Column) -> Column:
    latin = c.rlike(SCRIPTS["latin"]).cast("int")
    every = reduce(lambda a, b: a + b, (c.rlike(p).cast("int") for p in SCRIPTS.values()))
    return F.when(_none_of(c, _FOREIGN), latin).otherwise(every)


def dominant_script(c: Column) -> Column:
    """The script with most characters; null if it has fewer than three."""
    counts = F.array(*[F.struct(chars_of(c, p).alias("n"), F.lit(-i).alias("i"), F.lit(name).alias("name")) for i, (name, p) in enumerate(SCRIPTS.items())])
    most = let(F.array_max(counts), lambda best: F.when(best["n"] >= 3, best["name"]))
    # where there is only one script, three characters settle it
    return F.when(_none_of(c, _FOREIGN), F.when(c.rlike("(?:[A-Za-z][^A-Za-z]*+){3}"), "latin")).otherwise(most)


def strip_noise(c: Column) -> Column:
    """Without code blocks, inline code and addresses."""

    def code(x: Column) -> Column:
        return F.when(x.contains("`"), F.regexp_replace(F.regexp_replace(x, r"(?s)```.*?```", " "), r"`[^`\n]+`", " ")).otherwise(x)

    def addresses(x: Column) -> Column:
        return F.when(x.contains("://") | _www(x), F.regexp_replace(x, rf"(?iu)(?:https?://|www\.){NWS}+", " ")).otherwise(x)

    return let(code(c), addresses)


def detect_clean(c: Column, east: Column | None = None) -> Column:
    """:func:`detect_language` of a text without noise; ``east`` is :func:`has_east` where that is known."""
    counts = F.struct(*[chars_of(c, p).alias(name) for name, p in (("ko", HANGUL), ("ja", KANA), ("zh", HAN), ("la", LATIN))])

    def decide(n: Column) -> Column:
        total = n["ko"] + n["ja"] + n["zh"] + n["la"]
        share = lambda k: 10 * n[k] >= 3 * total
        return (
            F.when(total == 0, "unknown")
            .when((n["ja"] >= 2) | ((n["ja"] >= 1) & (n["ko"] == 0) & (n["la"] < 3)), "ja")
            .when(share("ko"), "ko")
            .when(share("zh"), "zh")
            .when(share("la"), F.when(c.rlike(VIETNAMESE), "vi").otherwise("en"))
            .when(n["ko"] > 0, "ko")
            .otherwise("unknown")
        )

    western = F.when(~c.rlike(LATIN), "unknown").when(~_ascii(c) & c.rlike(VIETNAMESE), "vi").otherwise("en")
    return F.when(blank(c), "unknown").when(~(has_east(c) if east is None else east), western).otherwise(let(counts, decide))


def detect_language(c: Column) -> Column:
    """ko, ja, zh, vi, en or unknown."""
    return let(strip_noise(text_of(c)), detect_clean)
