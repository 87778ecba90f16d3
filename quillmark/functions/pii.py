"""Personal data in a text: finding it and masking it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions.text import BLANKS, NOT_AFTER_DIGIT, NOT_AFTER_WORD, NWS, WB, WORD, WS, D, W, blank, let, text_of

PAIRS = "array<struct<kind: string, value: string>>"
_FREE = f"(?=[{D}+]){NOT_AFTER_DIGIT}", f"(?!{D})"
_SEP = r"[-. ]"
_WS = f"[{BLANKS}-]"
NOT_AFTER_WORD_AND_ONE = f"(?<![{WORD}\U00010000][MSRODmsrod])"

# Kinds and formats, in the order in which matches are reported.
PATTERNS = {
    "email": rf"{WB}[{WORD}.+-]+@[{WORD}-]+\.[{WORD}.-]{{2,}}{WB}",
    "phone": rf"{_FREE[0]}(?:\+?82{_SEP}?)?0?1[016789]{_SEP}?{D}{{3,4}}{_SEP}?{D}{{4}}{_FREE[1]}",
    "phone_landline": rf"{_FREE[0]}0{D}{{1,2}}{_SEP}{D}{{3,4}}{_SEP}{D}{{4}}{_FREE[1]}",
    "rrn": rf"{_FREE[0]}{D}{{6}}{_WS}?[1-4]{D}{{6}}{_FREE[1]}",
    "card": rf"{_FREE[0]}(?:{D}{{4}}{_WS}?){{3}}{D}{{4}}{_FREE[1]}",
    "account": rf"{_FREE[0]}{D}{{2,6}}-{D}{{2,6}}-{D}{{2,7}}{_FREE[1]}",
    "passport": rf"[MSRODmsrod](?={D}){NOT_AFTER_WORD_AND_ONE}{D}{{8}}(?!{W})",
    "ipv4": rf"{_FREE[0]}(?:{D}{{1,3}}\.){{3}}{D}{{1,3}}{_FREE[1]}",
    "biz_no": rf"{_FREE[0]}{D}{{3}}-{D}{{2}}-{D}{{5}}{_FREE[1]}",
}

#: One of them is in every match of the format "secret".
SECRET_WORDS = ("api", "secret", "token", "password")

# The formats that pack A looks for. Looking ahead for the first character saves looking behind elsewhere.
SENSITIVE = {
    "email": rf"{WB}[{WORD}.%+-]+@[{WORD}.-]+\.[A-Za-z]{{2,}}{WB}",
    "phone": rf"(?=0){NOT_AFTER_WORD}0{D}{{1,2}}[{BLANKS}.-]{D}{{3,4}}[{BLANKS}.-]{D}{{4}}(?!{W})",
    "rrn": rf"(?={D}){NOT_AFTER_WORD}{D}{{6}}-[1-8]{D}{{6}}(?!{W})",
    "card": rf"(?={D}){NOT_AFTER_WORD}{D}{{4}}{_WS}{D}{{4}}{_WS}{D}{{4}}{_WS}{D}{{4}}(?!{W})",
    "secret": rf"(?iu)(?:api[_-]?key|secret|token|password){WS}*[:=]{WS}*{NWS}{{12,}}",
    "url_auth": rf"https?://[^{BLANKS}:/@]+:[^{BLANKS}:/@]+@",
}


def valid_ipv4(value: Column) -> Column:
    """Every part at most 255."""
    return F.forall(F.split(value, r"\."), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)) <= 255)


def luhn16(value: Column) -> Column:
    """Exactly sixteen digits with a right check digit."""

    def check(digits: Column) -> Column:
        def add(total: Column, i: Column) -> Column:
            d = F.coalesce(F.substring(digits, i, F.lit(1)).try_cast("int"), F.lit(0))
            twice = F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
            return total + F.when(i % 2 == 1, twice).otherwise(d)

        return (F.length(digits) == 16) & (F.aggregate(F.sequence(F.lit(1), F.lit(16)), F.lit(0), add) % 10 == 0)

    return let(F.regexp_replace(value, f"[^{D}]", ""), check)


def find_pii(c: Column) -> Column:
    """(kind, value) of all matches, by kind and then by place."""

    def of(kind: str, pattern: str):
        def pairs(t: Column) -> Column:
            found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
            if kind == "ipv4":
                found = F.filter(found, valid_ipv4)
            if kind == "card":
                found = F.filter(found, luhn16)
            return F.transform(found, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

        return pairs

    def every(t: Column) -> Column:
        # no pattern matches without a digit or an @
        some = t.rlike(f"[{D}@]")
        return F.when(some, F.concat(*[of(k, p)(t) for k, p in PATTERNS.items()])).otherwise(F.array().cast(PAIRS))

    return let(text_of(c), every)


def contains_pii(c: Column) -> Column:
    """Whether :func:`find_pii` finds anything; stops at the first kind that does.

    All kinds but addresses have four digits in a row, or two with a hyphen or a dot between.
    """

    def any_of(t: Column) -> Column:
        out = F.lit(False)
        for kind, pattern in PATTERNS.items():
            if kind == "email":
                continue
            if kind in ("ipv4", "card"):
                found = F.exists(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), valid_ipv4 if kind == "ipv4" else luhn16)
            else:
                found = t.rlike(pattern)
            out = out | found
        return (t.contains("@") & t.rlike(PATTERNS["email"])) | (t.rlike(rf"{D}(?:{D}{{3}}|[.-]{D})") & out)

    return let(text_of(c), any_of)


def _masked(kind: Column, value: Column, mask: str, keep_tail: int) -> Column:
    sign = mask.replace("\\", "\\\\").replace("$", "\\$")
    local = F.substring_index(value, "@", 1)
    email = F.concat(F.substring(local, 1, 1), F.repeat(F.lit(mask), F.greatest(F.length(local) - 1, F.lit(1))), F.substring(value, F.length(local) + 1, F.length(value)))
    whole = F.regexp_replace(value, W, sign)
    if keep_tail > 0:
        head = F.substring(value, F.lit(1), F.length(value) - keep_tail)
        whole = F.when(F.length(value) > keep_tail, F.concat(F.regexp_replace(head, W, sign), F.right(value, F.lit(keep_tail)))).otherwise(whole)
    return F.when(kind == "email", email).otherwise(whole)


def mask_pii(c: Column, mask: str = "*", keep_tail: int = 0) -> Column:
    """The text with all matches masked, longer ones first; of e-mail addresses only the local part."""

    def every(t: Column) -> Column:
        ordered = F.array_sort(F.transform(find_pii(t), lambda p, i: F.struct((-F.length(p["value"])).alias("n"), i.alias("i"), p["kind"].alias("kind"), p["value"].alias("value"))))
        return F.when(blank(t), t).otherwise(F.aggregate(ordered, t, lambda s, p: F.replace(s, p["value"], _masked(p["kind"], p["value"], mask, keep_tail))))

    return let(text_of(c), every)
