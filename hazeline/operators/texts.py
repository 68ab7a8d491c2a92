"""HTML to text, cleaning, quality, language and chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions import patterns as pat

#: Removed in this order, anywhere, even inside words: that is the rule's meaning here.
_RULES = """cookie (banner|consent|notice|policy); gdpr (compliant|consent|notice); privacy policy; terms of (service|use); © \\d{4}[^\\n]*; all rights reserved;
skip (to )?(main )?content; page \\d+ of \\d+; \\A [-=*]{3,} \\z; share this (article|page|post)?; follow us (on)?; subscribe (to )?(our )?(newsletter)?;
related (articles?|links?|posts?); read more (articles?)?; leave a (comment|reply); comments? (area|section); (like|pin|share|tweet) (on )?\\w+; NAV; breadcrumb; advertisement;
sponsored (content|post)?; powered by \\w+; loading \\.\\.\\.; please wait; javascript (is )?(disabled|not enabled|required); enable javascript"""
_NAV = ("menu", "home", "search", "login", "sign (in|up)", "register", "close")
BOILERPLATE = [r.replace(" ", r"\s*") for rule in _RULES.split(";") for r in ([rf"\[? {w} \]?" for w in _NAV] if rule.strip() == "NAV" else [rule.strip()])]
CODE_LINE = r"^\s*(//|/\*|\*/|[\[\](){};]|#\s*(define|else|endif|if|include)|(class|const|def|else|except|for|from|function|if|import|let|raise|return|try|var|while|with)\s)"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))


def normalize_space(text: Column) -> Column:
    """No control characters, single blanks, at most two newlines in a row."""
    out = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")
    out = F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return F.regexp_replace(out, r"^\s+|\s+$", "")


def drop_boilerplate(text: Column) -> Column:
    """Every boilerplate rule in turn."""
    for rule in BOILERPLATE:
        text = F.regexp_replace(text, f"(?is){rule}", "")
    return text


def clean(text: Column) -> Column:
    """Null becomes empty."""
    return F.regexp_replace(drop_boilerplate(normalize_space(F.coalesce(text, F.lit("")))), r"^\s+|\s+$", "")


def html_to_text(html: Column) -> Column:
    """Text of a page by regular expressions."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    out = F.regexp_replace(out, r"<[^>]+>", " ")
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def html_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_description(html: Column) -> Column:
    return F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?is)<meta[^>]*name=["']description["'][^>]*content=["']([^"']*)["']""", 1)


class _Dom(HTMLParser):
    """Collects the text of every block, and of main or article, from one walk."""

    SKIP = frozenset("aside footer form header nav noscript script style".split())
    BLOCK = frozenset("article blockquote br div h1 h2 h3 h4 h5 h6 main p pre section table tr ul ol li".split())
    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip, self.main_at, self.main = 0, None, None
        self.lists: list[list] = []
        self.row: list[str] | None = None
        self.depth_main = 0
        self.blocks: list[list] = []
        self.best: tuple[int, str] = (0, "")

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.skip += 1
        if self.skip:
            return
        if tag in ("main", "article") and self.main is None:
            self.depth_main += 1
            if self.depth_main == 1:
                self.main_at = len(self.out)
        if tag in ("div", "section"):
            self.blocks.append([len(self.out), 0])
        if tag in ("ul", "ol"):
            self.lists.append([tag, 0])
        if tag == "tr":
            self.row = []
        if tag in ("td", "th") and self.row is not None:
            self.row.append("")
        if tag == "li":
            mark = "- "
            if self.lists:
                self.lists[-1][1] += 1
                mark = f"{self.lists[-1][1]}. " if self.lists[-1][0] == "ol" else "- "
            self.out.append("\n" + mark)
        elif tag in self.BLOCK:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skip = max(0, self.skip - 1)
            return
        if self.skip:
            return
        if tag == "tr" and self.row is not None:
            self.out.append(" | ".join(c.strip() for c in self.row))
            self.row = None
        if tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        if tag in ("div", "section") and self.blocks:
            at, n = self.blocks.pop()
            if n > self.best[0]:
                self.best = (n, "".join(self.out[at:]))
        if tag in ("main", "article") and self.depth_main:
            self.depth_main -= 1
            if not self.depth_main and self.main is None:
                self.main = "".join(self.out[self.main_at :])
        if tag in self.BLOCK:
            self.out.append("\n")

    def handle_data(self, data):
        if self.skip:
            return
        if self.row is not None and self.row:
            self.row[-1] += data
            return
        self.out.append(data)
        for b in self.blocks[-1:]:
            b[1] += len(data) if self.lasttag == "p" else 0

    def text(self) -> str:
        whole = self.main if self.main and self.main.strip() else self.best[1] or "".join(self.out)
        lines = [" ".join(re.split(r"[ \t]+", x)).strip() for x in whole.split("\n")]
        return re.sub(r"\n\n\n+", "\n" * 2, "\n".join(lines)).strip()


def dom_text(html: str | None) -> str:
    parser = _Dom()
    parser.feed(html or "")
    parser.close()
    return parser.text()


@F.pandas_udf(T.StringType())
def html_dom_text(pages: pd.Series) -> pd.Series:
    """Main text of a page by its structure: lists, tables as rows, main or article first."""
    return pages.map(dom_text)


def _field(html: Column, pattern: str) -> Column:
    return F.nullif(html_to_text(F.regexp_extract(html, f"(?is){pattern}", 1)), F.lit(""))


def github_advisory(html: Column) -> Column:
    """title, severity, description, affected_packages, cvss_score, links."""
    h = F.coalesce(html, F.lit(""))
    return F.struct(
        _field(h, r"<h1[^>]*>(.*?)</h1>").alias("title"),
        F.nullif(F.lower(F.regexp_extract(h, r"(?i)\b(critical|high|moderate|medium|low)\b(?:\s*</[^>]+>)?\s*(?:severity)?", 1)), F.lit("")).alias("severity"),
        _field(h, r"<(?:div|section)[^>]*class=[\"'][^\"']*(?:markdown-body|description)[^\"']*[\"'][^>]*>(.*?)</(?:div|section)>").alias("description"),
        F.regexp_extract_all(h, F.lit(r"(?is)<(?:span|td)[^>]*class=[\"'][^\"']*package[^\"']*[\"'][^>]*>\s*([^<]+?)\s*<"), F.lit(1)).alias("affected_packages"),
        F.regexp_extract(h, r"(?i)(?:cvss[^0-9]{0,40})(\d{1,2}\.\d)", 1).try_cast("double").alias("cvss_score"),
        F.array_distinct(F.regexp_extract_all(h, F.lit(r"(?i)<a[^>]+href=[\"'](https?://[^\"']+)"), F.lit(1))).alias("links"),
    )


def github_commit(html: Column) -> Column:
    """message, files, stats."""
    h = F.coalesce(html, F.lit(""))
    return F.struct(
        _field(h, r"<(?:p|div|h1)[^>]*class=[\"'][^\"']*commit-title[^\"']*[\"'][^>]*>(.*?)</(?:p|div|h1)>").alias("commit_message"),
        F.array_distinct(F.regexp_extract_all(h, F.lit(r"(?is)<a[^>]*title=[\"']([^\"']+\.[A-Za-z0-9]+)[\"']"), F.lit(1))).alias("files_changed"),
        F.nullif(F.regexp_extract(html_to_text(h), r"(?i)(\d+ changed files?[^.]*?deletions?|\d+ additions?[^.]*?deletions?)", 1), F.lit("")).alias("diff_stats"),
    )


def github_issue(html: Column) -> Column:
    """title, body, labels, state."""
    h = F.coalesce(html, F.lit(""))
    return F.struct(
        _field(h, r"<(?:bdi|h1)[^>]*>(.*?)</(?:bdi|h1)>").alias("title"),
        _field(h, r"<(?:div|td)[^>]*class=[\"'][^\"']*comment-body[^\"']*[\"'][^>]*>(.*?)</(?:div|td)>").alias("body"),
        F.array_distinct(F.regexp_extract_all(h, F.lit(r"(?is)<a[^>]*class=[\"'][^\"']*IssueLabel[^\"']*[\"'][^>]*>\s*([^<]+?)\s*<"), F.lit(1))).alias("labels"),
        F.nullif(F.lower(F.regexp_extract(h, r"(?is)class=[\"'][^\"']*State[^\"']*[\"'][^>]*>\s*(open|closed|merged)", 1)), F.lit("")).alias("state"),
    )


STOP = {
    "en": "the and of to in is that with for was",
    "de": "der die und das ist von mit nicht den auf",
    "fr": "les des est une dans pour que qui pas sur",
    "es": "los las una por con para del que como pero",
}


def language(text: Column) -> Column:
    """Most frequent stop words of the first 1000 characters; unknown under 50."""
    words = F.split(F.lower(F.substring(text, 1, 1000)), r"[^\p{L}]+")

    def known(stop: list[str]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(*stop)))

    scores = F.array(*[F.struct(known(s.split()).alias("n"), F.lit(lang).alias("lang")) for lang, s in sorted(STOP.items())])
    best = F.array_max(scores)
    return F.when(F.length(text) < 50, "unknown").when(best["n"] == 0, "unknown").otherwise(best["lang"])


def cut_chunks(text: str, most: int) -> list[str]:
    """Pieces of at most ``most`` bytes, cut at a late newline, else a sentence end, else hard."""
    if len(text.encode()) <= most:
        return [text] if text.strip() else []
    out, rest = [], text
    while rest:
        if len(rest.encode()) <= most:
            out.append(rest.strip())
            break
        piece = rest[:most]
        at = piece.rfind("\n")
        if at <= most // 2:
            at = piece.rfind(". ") + 1
        if at <= 0:
            at = most
        out.append(rest[:at].strip())
        rest = rest[at:]
    return [c for c in out if c]


def chunks(docs: DataFrame, most: int = 4000, text: str = "text") -> DataFrame:
    """Rows of ``docs`` with chunk_no and chunk in place of the text."""

    @F.pandas_udf("array<string>")
    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda t: cut_chunks(t or "", most))

    keep = [c for c in docs.columns if c != text]
    return docs.select(*keep, F.posexplode(cut(text)).alias("chunk_no", "chunk"))


def quality(text: Column, least: int = 50) -> Column:
    """label, text_length, sentence_count, has_cve_mention, has_version_mention, code_ratio."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, r"\r\n|[\n\r]"), lambda x: F.trim(x) != "")
    code = F.size(F.filter(lines, lambda x: x.rlike(CODE_LINE)))
    ratio = F.round(code / F.greatest(F.size(lines), F.lit(1)), 3)
    last = F.regexp_replace(t, r"\s+$", "")
    ends = F.when((last == "") | last.rlike(r"[.!?]\z"), 1).otherwise(0)
    n = F.regexp_count(t, F.lit(r"[.!?]+\s")) + ends
    size = F.length(t)
    label = F.when(size < least, "empty").when(ratio > 0.7, "code_only").when((n < 2) & (size < 200), "low").otherwise("good")
    none = size == 0
    return F.struct(
        label.alias("label"),
        size.cast("long").alias("text_length"),
        F.when(none, 0).otherwise(n).cast("long").alias("sentence_count"),
        t.rlike(pat.CVE).alias("has_cve_mention"),
        t.rlike(pat.VERSION).alias("has_version_mention"),
        F.when(none, 0.0).otherwise(ratio).alias("code_ratio"),
    )
