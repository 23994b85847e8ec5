"""Text mining of stored web pages."""

from __future__ import annotations

import html
import re
import urllib.parse

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import values as V
from .text import acceptable_emails, strings, unescape


def decode_cloudflare(c: Column) -> Column:
    """An address hidden as hexadecimal bytes, each XORed with the first."""
    byte = lambda i: F.conv(F.substr(c, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.floor(F.length(c) / 2).cast("int") - 1, F.lit(0))), lambda i: i > 0)
    return F.array_join(F.transform(places, lambda i: F.char(byte(i).bitwiseXOR(byte(F.lit(0))))), "")


def deobfuscate(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, V.HIDDEN_AT, "@"), V.HIDDEN_DOT, ".")


@F.pandas_udf(T.ArrayType(T.StringType()))
def raw_emails(page: pd.Series) -> pd.Series:
    """Addresses as they stand in pages, without escapes: mail links, hidden ones, then plain text; not yet cleaned."""
    uri, link, hidden, at, dot, plain = (re.compile(p) for p in (V.DATA_URI, V.MAILTO, V.CLOUDFLARE, V.HIDDEN_AT, V.HIDDEN_DOT, V.EMAIL))

    def shown(digits: str) -> str:
        key, *rest = (int(digits[i : i + 2], 16) for i in range(0, len(digits), 2))
        return "".join(chr(b ^ key) for b in rest)

    def one(text: str | None) -> list[str]:
        text = uri.sub(" ", (text or "")[:2_000_000])
        found = link.findall(text) + [shown(x) for x in hidden.findall(text)] + plain.findall(dot.sub(".", at.sub("@", html.unescape(text))))
        return [urllib.parse.unquote(html.unescape(x)) for x in found]

    return page.map(one)


def page_emails(page: Column) -> Column:
    """Distinct acceptable addresses of a page, in order."""
    return F.array_distinct(acceptable_emails(raw_emails(page)))


def without_tags(page: Column) -> Column:
    page = F.regexp_replace(page, r"(?is)<(script|style|noscript)\b.*?</\1>", " ")
    return F.regexp_replace(page, "<[^>]+>", " ")


def visible_text(page: Column) -> Column:
    return unescape(without_tags(page))


def words(text: Column) -> Column:
    """Number of words."""
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda x: x != ""))


def soft_redirect(page: Column) -> Column:
    """Target of a page that only forwards, else null."""
    target = F.coalesce(*[F.nullif(F.regexp_extract(page, V.REDIRECT, i), F.lit("")) for i in (1, 2)])
    return F.when(F.length(page) <= 3000, target)


def site_status(text: Column) -> Column:
    """parked, closed or ok, from visible text."""
    return F.when(text.rlike(V.PARKED_PAGE) & (words(text) < 400), "parked").when(text.rlike(V.CLOSED_PAGE), "closed").otherwise("ok")


def page_language(page: Column, text: Column | None = None) -> Column:
    """English, Bilingual or Local."""
    text = visible_text(F.substring(page, 1, 1_000_000)) if text is None else text
    latin, thai = F.regexp_count(text, F.lit("[A-Za-z]")), F.regexp_count(text, F.lit("[฀-๿]"))
    ratio = F.when(latin + thai > 0, latin / (latin + thai)).otherwise(F.lit(0.0))
    declared = F.lower(F.regexp_extract(F.substring(page, 1, 5000), V.DECLARED_LANGUAGE, 1))
    return (
        F.when((ratio >= 0.85) | (declared.startswith("en") & (ratio >= 0.6)), "English")
        .when((ratio >= 0.3) | F.substring(page, 1, 1_000_000).rlike(V.ENGLISH_VERSION), "Bilingual").otherwise("Local")
    )


def fetch_status(code: Column, error: Column) -> Column:
    """dead if the page or its domain is gone, else unknown."""
    gone = code.isin(404, 410) | F.coalesce(error, F.lit("")).rlike("(?i)name or service not known|nodename nor servname|nxdomain")
    return F.when(F.coalesce(gone, F.lit(False)), "dead").otherwise("unknown")


def contact_links(page: Column, base: Column, limit: int = 4) -> Column:
    """Links of the same host that hint at contact pages, resolved and distinct."""
    link, hint, tag = (regex.compile(p) for p in (V.LINK, V.CONTACT_HINT, "<[^>]+>"))

    def host(u: str) -> str:
        return urllib.parse.urlparse(u).netloc.lower().removeprefix("www.")

    def one(page: str, base: str) -> list[str]:
        out: list[str] = []
        for href, label in link.findall(page):
            if hint.search(href) or hint.search(tag.sub("", label)):
                try:
                    url = urllib.parse.urljoin(base, html.unescape(href))
                    same = urllib.parse.urlparse(url).scheme in ("http", "https") and host(url) == host(base)
                except ValueError:
                    continue
                if same and url.rstrip("/") != base.rstrip("/") and url not in out:
                    out.append(url)
        return out[:limit]

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(page: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([one(p or "", b or "") for p, b in zip(page, base, strict=True)])

    return run(page, base)


def name_words(slug_words_: Column) -> Column:
    """Words of a name that can prove a page to be its own."""
    found = F.regexp_extract_all(F.upper(slug_words_), F.lit("([A-Z0-9]+)"), F.lit(1))
    return F.filter(found, lambda w: (F.length(w) >= 4) & ~F.lower(w).isin(V.GENERIC))


def evidence(text: Column, postcode: Column, phone: Column, own_words: Column, name_slug: Column, text_slug: Column, country: str = "44", least_digits: int = 10, postcode_needs_name: bool = False, city: str = "") -> Column:
    """postcode, phone or name + city, if ``text`` shows that a page is the venue's; else empty."""
    flat = F.regexp_replace(F.upper(text), r"\s+", "")
    by_postcode = (F.length(postcode) >= 5) & F.contains(flat, postcode)
    if postcode_needs_name:
        by_postcode &= F.exists(own_words, lambda w: F.contains(flat, w))
    number = F.when(phone.startswith(country), F.concat(F.lit("0"), F.substr(phone, F.lit(len(country) + 1)))).otherwise(phone)
    shown = F.regexp_replace(text, "[^0-9]", "")
    by_phone = (F.length(number) >= least_digits) & (F.contains(shown, number) | F.contains(shown, F.substr(number, F.lit(2))))
    out = F.when(by_postcode, "postcode").when(by_phone, "phone")
    if city:
        out = out.when((F.length(name_slug) >= 6) & F.contains(text_slug, name_slug) & text.rlike("(?iu)" + city), "name + city")
    return out.otherwise("")


def fallback_urls(site: Column) -> Column:
    root = F.regexp_extract(site, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    return F.transform(strings(V.FALLBACK_PATHS), lambda p: F.concat(root, p))
