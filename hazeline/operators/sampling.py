"""Heuristic pre-labels and gold-set sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.functions import lexicon as lex
from hazeline.functions import patterns as pat


def _if(condition: Column, x: float) -> Column:
    return F.when(condition, x).otherwise(0.0)


#: label -> (terms, weight of each, most of all): terms stand anywhere in the text, in either case
PRELABEL_TERMS = {
    "vulnerability": [(lex.terms("advisory|affected versions|cvss|cwe-|patch|security update|vulnerability"), 0.1, 0.5)],
    "exploit": [(lex.terms("0day|exploit code|exploit-db|metasploit|payload|poc|proof of concept|rce exploit|shellcode|zero-day"), 0.15, None)],
    "phishing": [(lex.terms("credential harvesting|fake login|lure|phishing|phishing kit|social engineering|spear-phishing|spoofed"), 0.15, None)],
    "ransomware": [
        (lex.terms("data leak|decryptor|double extortion|encrypt|ransom|ransom note|ransomware"), 0.15, None),
        (lex.terms("8base|akira|alphv|blackbasta|blackcat|clop|conti|hive|lockbit|medusa|play|revil|rhysida|royal"), 0.2, None),
    ],
    "threat_actor": [
        (lex.terms("attributed to|campaign|espionage|intrusion set|nation-state|suspected|threat actor|threat group"), 0.1, None),
        (lex.terms("cozy bear|equation group|fancy bear|kimsuky|lazarus|mustang panda|sandworm|turla"), 0.2, None),
    ],
    "ioc": [(lex.terms("beacon|c2|callback|command and control|indicator|indicators of compromise|ioc"), 0.1, None)],
}
ACTOR_NUMBER = r"(?i)(?:apt-?|unc|fin|ta)[0-9]+"
ANY_DOMAIN = r"\b(?:[0-9A-Za-z](?:[-0-9A-Za-z]*[0-9A-Za-z])?\.)+[A-Za-z]{2,}\b"


def _score(label: str, low: Column) -> Column:
    """Weights of the label's terms that ``low``, a lower-cased text, holds."""
    total = F.lit(0.0)
    for words, each, most in PRELABEL_TERMS[label]:
        own = sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0)) * F.lit(each)
        total = total + (own if most is None else F.least(own, F.lit(most)))
    return total


def prelabel_scores(docs: DataFrame) -> DataFrame:
    """``docs`` with a score of each label in two digits."""
    t = F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit("")))
    low, hint = F.lower(t), F.lower(F.coalesce(F.col("source_category_hint"), F.lit("")))
    count = lambda p: F.regexp_count(t, F.lit(p))
    hashes = count(pat.MD5) + count(pat.SHA1) + count(pat.SHA256)
    more = {
        "vulnerability": _if(t.rlike(pat.CVE), 0.4),
        "exploit": _if(F.contains(low, F.lit("github.com")) & (F.contains(low, F.lit("exploit")) | F.contains(low, F.lit("poc"))), 0.3),
        "phishing": _if(hint == "phishing", 0.3),
        "ransomware": F.lit(0.0),
        "threat_actor": _if(t.rlike(ACTOR_NUMBER), 0.4),
        "ioc": _if(count(pat.IPV4_WORD) > 3, 0.4) + _if(hashes > 2, 0.3) + _if(count(ANY_DOMAIN) > 3, 0.2),
    }
    return docs.withColumns({f"pre_{k}": F.round(F.least(v + _score(k, low), F.lit(1.0)), 2) for k, v in more.items()})


def prelabels(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """id, labels (joined), confidence, needs_review."""
    rows = prelabel_scores(docs)
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"pre_{k}").alias("v")) for k in lex.CATEGORIES])
    kept = F.filter(pairs, lambda p: p["v"] >= least)
    n, values = F.size(kept), F.transform(kept, lambda p: p["v"])
    cents = F.aggregate(F.transform(values, lambda v: F.round(v * 100).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
    mean = cents / 100 / F.greatest(n, F.lit(1))
    review = (n == 0) | (n > 3) | (F.coalesce(F.array_max(values), F.lit(0.0)) < 0.5)
    return rows.select("ord", "id", "source_category_hint", F.array_join(F.transform(kept, lambda p: p["k"]), "|").alias("labels"), F.bround(mean, 2).alias("confidence"), review.alias("needs_review"))


def stratified(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows: of each hint, in the order in which hints are met, every step-th row; then the
    first rows not yet taken, one of each hint in turn; doubtful ones first (P08).

    The step is the stratum's size by its even share, and goes through the whole stratum, so
    early strata may leave no room for late ones. A stratum may hold a third of all rows, so
    places come from counts of blocks of rows and a window inside each block, not from one
    window over the stratum.
    """
    stratum = F.coalesce(F.nullif("source_category_hint", F.lit("")), F.lit("unknown"))
    base = rows.withColumn("stratum", stratum).withColumn("block", F.floor(F.col("ord") / 65536))
    inside = base.withColumn("at", F.row_number().over(Window.partitionBy("stratum", "block").orderBy("ord")))
    sizes = base.groupBy("stratum", "block").agg(F.count("*").alias("m"), F.min("ord").alias("o"))
    whole = Window.partitionBy("stratum")
    before = sizes.withColumns({"skip": F.coalesce(F.sum("m").over(whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "size": F.sum("m").over(whole), "met": F.min("o").over(whole)})
    strata = sizes.groupBy().agg(F.count_distinct("stratum").alias("strata"))
    placed = inside.join(before.drop("m", "o"), ["stratum", "block"]).join(F.broadcast(strata)).withColumn("pos", F.col("skip") + F.col("at") - 1)
    take = F.least(F.greatest(F.floor(F.lit(n) / F.col("strata")), F.lit(1)), F.col("size"))
    placed = placed.withColumn("step", F.greatest(F.floor(F.col("size") / take), F.lit(1)))
    # of a stratum at most n rows are taken, and at most n more can follow in turn
    near = placed.where((F.col("pos") % F.col("step") == 0) & (F.floor(F.col("pos") / F.col("step")) < n) | (F.col("pos") < 2 * n))
    first = near.where("pos % step = 0").orderBy("met", "pos").limit(n).withColumn("turn", F.lit(-1).cast("long"))
    rest = near.join(first.select("stratum", "pos"), ["stratum", "pos"], "left_anti")
    rest = rest.withColumn("turn", F.row_number().over(Window.partitionBy("stratum").orderBy("pos")).cast("long"))
    chosen = first.unionByName(rest).orderBy("turn", "met", "pos").limit(n)
    return chosen.orderBy(F.desc("needs_review"), "confidence", "ord").select(*rows.columns)


def hash_sample(docs: DataFrame, n: int, least_chars: int = 0) -> DataFrame:
    """``n`` rows in the order of a hash of the id: the same at every run."""
    return docs.where(F.length(F.coalesce("content", F.lit(""))) >= least_chars).orderBy(F.xxhash64("id"), "id").limit(n)


#: label -> signals of the plain substring labeller, in the order in which they add up:
#: ("words", list, weight of each, most), ("like", pattern, bonus), ("many", patterns, more than, bonus; in the content), ("source", name, bonus), ("hint", bonus)
OSINT = {
    "vulnerability": [
        ("like", r"(?U)cve-\d{4}-\d{4,}", 0.35),
        ("words", lex.terms("vulnerability|advisory|patch|security update|cwe-|affected versions|cvss|remediation|buffer overflow|injection|cross-site|denial of service|privilege escalation|authentication bypass|information disclosure"), 0.08, 0.5),
    ],
    "exploit": [
        ("words", lex.terms("proof of concept|poc|exploit code|metasploit|rce exploit|shellcode|0day|zero-day|weaponized|exploitation|exploit|remote code execution|arbitrary code|code execution"), 0.12, 0.8),
        ("words", ["exploit-db"], 0.25, 0.25),
        ("source", "exploitdb", 0.3),
        ("hint", 0.15),
    ],
    "phishing": [("words", lex.PHISHING, 0.2, 0.8), ("source", "phishtank", 0.4), ("hint", 0.2)],
    "ransomware": [
        ("words", lex.terms("ransomware|ransom|encrypt|decryptor|double extortion|data leak|ransom note|file encryption|leak site"), 0.12, 0.7),
        ("words", lex.terms("lockbit|blackcat|alphv|conti|revil|clop|hive|royal|akira|play|8base|medusa|blackbasta|rhysida|vice society|cuba|ragnar"), 0.2, 0.6),
        ("source", "ransomwatch", 0.35),
        ("hint", 0.15),
    ],
    "threat_actor": [
        ("like", r"(?U)(?=(?:apt|unc|fin|ta)\d)\b(?:apt|unc|fin|ta)\d+\b", 0.4),
        ("words", lex.terms("threat actor|threat group|attributed to|nation-state|espionage|campaign|intrusion set|state-sponsored|apt"), 0.1, 0.5),
        ("words", lex.terms("lazarus|cozy bear|fancy bear|sandworm|turla|kimsuky|mustang panda|charming kitten|hafnium|nobelium|wizard spider|darkside|fin7|fin11|carbanak|ocean lotus|winnti"), 0.2, 0.6),
        ("source", "mitre_attack", 0.3),
        ("hint", 0.15),
    ],
    "ioc": [
        ("many", [r"(?U)(?=\d{1,3}\.)\b(?:\d{1,3}\.){3}\d{1,3}\b"], 3, 0.4),
        ("many", [rf"(?U)(?=[a-f0-9]{{{n}}})\b[a-f0-9]{{{n}}}\b" for n in (32, 40, 64)], 2, 0.3),
        ("words", lex.terms("indicator of compromise|ioc|c2|command and control|beacon|callback|indicator|infrastructure"), 0.1, 0.5),
        ("source", "otx", 0.3),
        ("hint", 0.15),
    ],
}


#: the same for documents of CVE records, whose tags, CVSS and weaknesses count too (P10)
CVE_LABELS = {
    "vulnerability": [
        ("like", r"(?U)cve-\d{4}-\d{4,}", 0.3),
        ("words", [*OSINT["vulnerability"][1][1], "out-of-bounds"], 0.08, 0.5),
        ("words", ["cwe-"], 0.1, 0.1),
        ("scored", 0.1),
        ("tagged", ["vendor advisory", "patch"], 0.1),
    ],
    "exploit": [
        ("words", OSINT["exploit"][0][1], 0.12, 0.8),
        ("tagged", ["exploit", "third party advisory"], 0.2),
        ("linked", 0.2),
        ("exploitable", 3.0, 0.15),
        ("severe", "CRITICAL", 0.1),
    ],
    "phishing": [("words", PRELABEL_TERMS["phishing"][0][0], 0.2, 0.9)],
    "ransomware": [("words", lex.terms("ransomware|ransom|encrypt|decryptor|double extortion|data leak|ransom note|file encryption"), 0.15, 0.9), ("words", PRELABEL_TERMS["ransomware"][1][0], 0.25, 99.0)],
    "threat_actor": [
        ("like", r"(?U)(?=(?:apt|unc|fin|ta)\d)\b(?:apt|unc|fin|ta)\d+\b", 0.4),
        ("words", lex.terms("threat actor|threat group|attributed to|nation-state|espionage|campaign|intrusion set|state-sponsored"), 0.12, 0.5),
        ("words", lex.terms("lazarus|cozy bear|fancy bear|sandworm|turla|kimsuky|mustang panda|charming kitten|hafnium|nobelium"), 0.25, 99.0),
    ],
    "ioc": [*OSINT["ioc"][:2], ("words", lex.terms("indicator of compromise|ioc|c2|command and control|beacon|callback"), 0.12, 0.5)],
}


def _lowered(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """``docs`` with title and content in lower case, and the content alone: columns, so that no signal makes them anew."""
    docs = docs.withColumn("_content", F.lower(F.coalesce("content", F.lit(""))))
    docs = docs.withColumn("_all", F.concat_ws(" ", F.lower(F.coalesce("title", F.lit(""))), "_content"))
    return docs, F.col("_all"), F.col("_content")


def cve_labels(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """id, labels (name=confidence, in the order of CVE_LABELS) of documents of CVE records (P10).

    docs: id, title, content, ref_tags (array), and of the CVSS metric score, severity and exploitability.
    """
    docs, t, content = _lowered(docs)
    tags = F.transform(F.coalesce("ref_tags", F.array().cast("array<string>")), lambda x: F.lower(x))
    has = lambda w: F.contains(t, F.lit(w))
    known = {
        "scored": lambda x: _if(F.coalesce(F.col("score") != 0, F.lit(False)), x),
        "tagged": lambda names, x: _if(F.arrays_overlap(tags, F.array(*map(F.lit, names))), x),
        "linked": lambda x: _if(has("exploit-db") | (has("github.com") & has("exploit")), x),
        "exploitable": lambda bound, x: _if(F.coalesce(F.col("exploitability") >= bound, F.lit(False)), x),
        "severe": lambda name, x: _if(F.coalesce(F.col("severity") == name, F.lit(False)), x),
    }
    of = lambda kind, *x: known[kind](*x) if kind in known else _signal(t, content, kind, *x)
    scores = F.array(*[F.struct(F.lit(k).alias("k"), F.round(F.least(sum((of(*s) for s in signals), F.lit(0.0)), F.lit(1.0)), 6).alias("v")) for k, signals in CVE_LABELS.items()])
    kept = F.filter(scores, lambda p: p["v"] >= least)
    return docs.select("id", F.array_join(F.transform(kept, lambda p: F.concat(p["k"], F.lit("="), F.format_string("%.2f", p["v"]))), "|").alias("labels"))


def _signal(t: Column, content: Column, kind: str, *x) -> Column:
    """The weight of one signal of a table like OSINT, as far as the text decides it."""
    if kind == "words":
        return F.least(sum((F.contains(t, F.lit(w)).cast("int") for w in x[0]), F.lit(0)) * F.lit(x[1]), F.lit(x[2]))
    if kind == "many":
        return _if(sum((F.regexp_count(content, F.lit(p)) for p in x[0]), F.lit(0)) > x[1], x[2])
    return _if(t.rlike(x[0]), x[1])


def substring_labels(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """id, primary_label, labels, confidence, preview from plain substrings and a few patterns.

    Labels of equal confidence stand in the order of OSINT; without any, the hint stands in
    at 0.2, and 'unknown' at 0 where there is none.
    """
    docs, t, content = _lowered(docs)
    hint = F.coalesce(F.col("source_category_hint"), F.lit(""))
    source = F.coalesce(F.col("source"), F.lit(""))

    def signal(label: str, kind: str, *x) -> Column:
        if kind in ("source", "hint"):
            return _if(source == x[0] if kind == "source" else hint == label, x[-1])
        return _signal(t, content, kind, *x)

    # columns of their own: inside the arrays below, which ask for them twice, they would be computed twice
    docs = docs.withColumns({f"_{label}": F.least(sum((signal(label, *s) for s in signals), F.lit(0.0)), F.lit(1.0)) for label, signals in OSINT.items()})
    scores = [F.struct(F.col(f"_{label}").alias("v"), F.lit(-i).alias("turn"), F.lit(label).alias("k")) for i, label in enumerate(OSINT)]
    kept = F.filter(F.array(*scores), lambda p: p["v"] >= least)
    none = F.struct(F.when(hint == "", 0.0).otherwise(0.2).alias("v"), F.lit(0).alias("turn"), F.when(hint == "", "unknown").otherwise(hint).alias("k"))
    best = F.sort_array(F.when(F.size(kept) == 0, F.array(none)).otherwise(kept), asc=False)
    rows = docs.select("ord", "id", best.alias("best"), F.substring(F.coalesce("content", F.lit("")), 1, 300).alias("preview"))
    return rows.select("ord", "id", F.col("best")[0]["k"].alias("primary_label"), F.array_join(F.transform("best", lambda p: p["k"]), "|").alias("labels"), F.round(F.col("best")[0]["v"], 2).alias("confidence"), "preview")
