"""URL normalising, hashing and classing, document ids, references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions import lexicon as lex
from hazeline.functions import patterns as pat

URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URL, group)


def decoded(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), x)


def normalize(url: Column) -> Column:
    """Lower-cased scheme and host, no fragment, no tracking or blank parameters, sorted keys, values of one key joined, no trailing slash."""
    pairs = F.transform(F.split(part(url, 4), "&"), lambda p: F.struct(decoded(F.split_part(p, F.lit("="), F.lit(1))).alias("k"), decoded(F.regexp_extract(p, r"^[^=]*=(.*)$", 1)).alias("v")))
    kept = F.filter(pairs, lambda p: (p["v"] != "") & ~F.lower(p["k"]).isin(*sorted(lex.TRACKING)))
    keys = F.array_sort(F.array_distinct(F.transform(kept, lambda p: p["k"])))
    each = F.transform(keys, lambda k: F.concat(k, F.lit("="), F.array_join(F.transform(F.filter(kept, lambda p: p["k"] == k), lambda p: p["v"]), ",")))
    query = F.array_join(each, "&")
    scheme = F.coalesce(F.nullif(F.lower(part(url, 1)), F.lit("")), F.lit("https"))
    path = F.rtrim(part(url, 3), F.lit("/"))
    path = F.when(path == "", "/").otherwise(path)
    return F.concat(scheme, F.lit("://"), F.lower(part(url, 2)), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def hash8(url: Column) -> Column:
    """First 8 hex digits of the SHA-256 of the normal form."""
    return F.substring(F.sha2(normalize(url), 256), 1, 8)


def sha8(text: Column) -> Column:
    """First 8 hex digits of the SHA-256 of a text, as the ids of feed documents end."""
    return F.substring(F.sha2(text, 256), 1, 8)


def classify(url: Column) -> Column:
    """One of 12 classes, the first rule that fits."""
    host = F.regexp_replace(F.split_part(F.lower(part(url, 2)), F.lit(":"), F.lit(1)), r"^www\.", "")
    path = part(url, 3)
    low = F.lower(path)
    github = F.when(F.contains(path, F.lit("/advisories/GHSA-")), "github_advisory").when(F.contains(low, F.lit("/commit/")), "github_commit").when(F.contains(low, F.lit("/issues/")) | F.contains(low, F.lit("/pull/")), "github_issue").otherwise("github_repo")
    return (
        F.when(url.isNull() | (F.trim(url) == "") | (part(url, 2) == ""), "unknown")
        .when(host.isin(*lex.GITHUB_CODE), "code")
        .when(host == "github.com", github)
        .when(host.isin(*lex.MEDIA_HOSTS), "media")
        .when(host.isin(*lex.PASTE_HOSTS), "code")
        .when(host.isin(*lex.LIST_HOSTS) | host.startswith("lists."), "mailing_list")
        .when(host.rlike(r"\.gov(\.uk|\.au)?$") | host.isin(*lex.GOV_HOSTS), "government")
        .when(host.isin(*lex.ADVISORY_HOSTS), "vendor_advisory")
        .when(low.rlike(pat.PATCH_PATH), "patch")
        .when(path.rlike(pat.ADVISORY_PATH), "vendor_advisory")
        .otherwise("article")
    )


def with_hint(base: Column, title: Column, first_paragraph: Column) -> Column:
    """An article that speaks of an advisory is one."""
    text = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(first_paragraph, F.lit(""))))
    said = F.lit(False)
    for hint in lex.HINTS:
        said = said | F.contains(text, F.lit(hint))
    return F.when((base == "article") & said, "vendor_advisory").otherwise(base)


def references(records: DataFrame) -> DataFrame:
    """cve_id, idx, url, tags of every reference; ``refs`` is JSON of either shape."""
    new = F.from_json("refs", "array<struct<url:string,source:string,tags:array<string>>>")
    old = F.from_json("refs", "struct<reference_data:array<struct<url:string,source:string,tags:array<string>>>>")["reference_data"]
    either = F.when(F.col("refs").startswith("["), new).otherwise(old)
    return records.select("cve_id", F.posexplode(F.coalesce(either, F.array().cast("array<struct<url:string,source:string,tags:array<string>>>"))).alias("idx", "r")).select("cve_id", "idx", "r.url", "r.tags")


def reference_stats(refs: DataFrame) -> DataFrame:
    """references, media_references, cves_with_references."""
    return refs.agg(F.count("*").alias("n_references"), F.count_if(classify(F.col("url")) == "media").alias("media_references"), F.count_distinct("cve_id").alias("cves_with_references"))


def outcome_counts(rows: DataFrame) -> DataFrame:
    """processed, succeeded, failed, skipped_media from ref_type and status."""
    media = F.col("ref_type") == "media"
    ok = F.coalesce((F.col("status") < 400) & F.col("url").rlike("(?i)^https?://"), F.lit(False))
    return rows.agg(F.count_if(~media).alias("processed"), F.count_if(~media & ok).alias("succeeded"), F.count_if(~media & ~ok).alias("failed"), F.count_if(media).alias("skipped_media"))


def sniff(header: Column, body: Column) -> Column:
    """Content type: the header's, else by the first bytes."""
    named = F.nullif(F.lower(F.trim(F.split_part(F.coalesce(header, F.lit("")), F.lit(";"), F.lit(1)))), F.lit(""))
    start = F.ltrim(F.decode(F.substring(body, 1, 64), "ISO-8859-1"))
    magic = F.when(start.startswith("%PDF"), "application/pdf").when(start.startswith("{"), "application/json").when(start.startswith("<"), "text/html").otherwise("application/octet-stream")
    return F.coalesce(named, magic)


def charset(header: Column) -> Column:
    """Character set named in a content type, utf-8 if none."""
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(F.coalesce(header, F.lit("")), r"(?i)charset=[\"']?([\w.-]+)", 1)), F.lit("")), F.lit("utf-8"))


EXTENSIONS = {"application/json": ".json", "application/pdf": ".pdf", "text/html": ".html", "text/plain": ".txt"}


def object_key(root: str, date: Column, folder: str, cve: Column, idx: Column, url: Column, mime: Column) -> Column:
    """Storage key of one fetched reference (K04); folder is raw, clean or meta."""
    if folder not in ("raw", "clean", "meta"):
        raise ValueError(f"no such folder: {folder}")
    by_mime = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in EXTENSIONS.items() for x in pair]), mime), F.lit(".bin"))
    ext = by_mime if folder == "raw" else F.lit(".txt" if folder == "clean" else ".json")
    return F.concat(F.lit(f"{root}/"), date, F.lit(f"/{folder}/"), cve, F.lit("/"), F.lpad(idx.cast("string"), 3, "0"), F.lit("_"), hash8(url), ext)


def fresh_only(new: DataFrame, history: DataFrame, days: int = 30) -> DataFrame:
    """References that history does not hold within ``days``."""
    n, h = new.alias("n"), history.alias("h")
    return n.join(h, (F.col("n.url_hash") == F.col("h.url_hash")) & (F.col("h.fetched_at") >= F.col("n.fetched_at") - F.expr(f"INTERVAL {days} DAYS")) & (F.col("h.fetched_at") <= F.col("n.fetched_at")), "left_anti")


def route(ref_type: Column, mime: Column) -> Column:
    """Which extractor a fetched reference goes to."""
    return (
        F.when(ref_type == "media", "skip").when(ref_type == "code", "code").when(mime == "application/pdf", "pdf").when(mime == "application/json", "json")
        .when(mime.contains("html"), F.when(ref_type.isin("github_advisory", "github_commit", "github_issue"), ref_type).otherwise("html")).otherwise("text")
    )
