"""Link checks of both packs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions.text import BLANKS, NWS, WB, blank, let, py_strip

# Links of Markdown, bare addresses of pack B, and marks of placeholders in addresses.
_MARKDOWN = r"\[[^\]]*\]\(([^)]*)\)"
_BARE_B = rf"(?iu)(?<![(\]]){WB}(?:https?://|www\.)[^{BLANKS}<>\"'`)\]]+"
PLACEHOLDER_HOSTS = ("example.com", "example.org", "example.net", "yourdomain", "localhost", "127.0.0.1", "test.com", "abc.com", "url.com")
PLACEHOLDER_MARKS = ("<", ">", "{", "}", "링크", "url_here", "insert", "your-", "xxx")

# What makes an address of pack B invalid, by the whole address or by its host, in lower case.
TYPO = r"^(?:htt?ps?:/(?!/)|htt?ps?//|ht+ps?:)"
TYPO_STRICT = r"^(?:htt?ps?:/(?!/)|htt?ps?//|(?!https?:)ht+ps?:)"
BAD_ADDRESS = {
    "placeholder": "|".join(rf"\Q{mark}\E" for mark in (*PLACEHOLDER_MARKS, *PLACEHOLDER_HOSTS)),
    "no address": r"^(?!https?://|www\.|/)",
    "blank inside": " ",
    "no host at all": r"^www\./*\z",
}
BAD_HOST = {"empty": r"\A\z", "dot at an end": r"\A\.|\.\z", "two dots": r"\.\."}
DOMAIN = r"(?iu)\.[a-z]{2,24}(?:(?=\n?\z)|[/:?#])"


def _all(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def valid_target(url: Column) -> Column:
    """Pack A: an absolute web address with a host, or a place in the same site."""
    host = F.get(F.split(F.regexp_replace(url, r"^https?://", ""), "/", -1), F.lit(0))
    return url.rlike(r"^[/#]") | (url.rlike(r"^https?://") & host.contains(".") & ~host.startswith(".") & ~host.endswith("."))


def invalid_link_a(text: Column) -> Column:
    targets = F.transform(_all(text, _MARKDOWN, 1), py_strip)
    bare = F.transform(_all(text, rf"(?<!\(){WB}https?://{NWS}+", 0), lambda u: F.regexp_replace(u, r"[.,;:!?)]+\z", ""))
    return (text.contains("](") | text.contains("http")) & F.exists(F.concat(targets, bare), lambda u: ~valid_target(u))


def invalid_url(url: Column, strict_scheme_fix: bool = False) -> Column:
    """Pack B. The rule for misspelt schemes also takes every right one; ``strict_scheme_fix`` leaves those alone."""
    address = "|".join([*BAD_ADDRESS.values(), TYPO_STRICT if strict_scheme_fix else TYPO])

    def of(low: Column) -> Column:
        host = F.regexp_extract(low, "^(?:https?://)?([^/?#]*)", 1)
        return (low == "") | low.rlike(address) | host.rlike("|".join(BAD_HOST.values())) | ~F.concat(host, F.lit("/")).rlike(DOMAIN)

    return let(F.lower(py_strip(url)), of)


def invalid_link_b(text: Column, strict_scheme_fix: bool = False) -> Column:
    bad = lambda u: invalid_url(u, strict_scheme_fix)
    rest = F.regexp_replace(text, _MARKDOWN, " ")
    some = text.contains("](") | text.rlike("[HhWw](?:[Tt][Tt][Pp]|[Ww][Ww])")  # http or www, and what costs only time
    return ~blank(text) & some & (
        F.exists(_all(text, _MARKDOWN, 1), bad) | F.exists(_all(rest, _BARE_B, 0), bad) | text.rlike(r"\[[^\]]*\]\([^)]*\z")
    )
