"""Regular expressions, in the Java form that plans use and, where they differ, the RE2 form for SQL checks."""

CVE = r"(?i)CVE-[0-9]{4}-[0-9]{4,}"
CVE_ENTITY = r"(?i)CVE-[0-9]{4}-[0-9]{4,7}"
CVSS_NEAR = r"(?i)CVSS[^0-9]*[0-9][.][0-9]"
SEVERITY = r"(?i)severity\s*:\s*(high|critical)"
EXPLOIT_LINK = r"(?i)(github\.com\S*/(poc|exploit)|exploit-db\.com)"
OCTET = r"(?:2(?:5[0-5]|[0-4][0-9])|[01]?[0-9]{1,2})"
IPV4_WORD = rf"\b(?:{OCTET}\.){{3}}{OCTET}\b"
IPV4 = rf"(?<![0-9])(?<!\\.){OCTET}(?:\.{OCTET}){{3}}(?![.][0-9])"
IPV6 = r"\b(?:[A-Fa-f0-9]{1,4}:){2,7}[A-Fa-f0-9]{1,4}\b"
MD5, SHA1, SHA256 = (rf"\b[A-Fa-f0-9]{{{n}}}\b" for n in (32, 40, 64))
HEX = "[A-Fa-f0-9]{32}"  #: a run that each of these holds
APT = r"(?i)\b(APT|FIN|TA|UNC)\d+\b"
TLDS = "biz|cn|com|de|edu|fr|gov|info|io|net|onion|org|ru|top|uk|xyz"
DOMAIN = rf"(?i)(?<!/)\b(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+(?:{TLDS})\b"
DOMAIN_RE2 = rf"(?i)\b(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+(?:{TLDS})\b"
URL = r"""https?://[^\s<>"')\]}|]+(?:["')\]}|]|\s|$)?"""
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+(?:\.[A-Za-z]{2,})+\b"
CVSS_VALUE = r"(?i)CVSS[\s:]*([0-9]+[.][0-9]+)"
CVSS_VECTOR = r"CVSS:3[.][0-9]/AV:[^/]+" + "".join(rf"/{k}:[^/]+" for k in ("AC", "PR", "UI", "S", "C", "I", "A")) + r"[^\s]*"
CVSS_OTHER = (r"(?i)severity[\s:]+([0-9]+[.][0-9]+)", r"(?i)score[\s:]+([0-9]+[.][0-9]+)", r"([0-9]+[.][0-9]+)\s*/\s*10(?:\s|$|[,.)])")
VERSION_BEFORE = r"(?i)v(?:ersion)?\s*\d*\s*$"
VERSION = r"(?i)(v|version)?\s*\d+[.]\d+(\.\d+)*([-._]?\w+)?"
CRITICAL = r"(?is)\bcritical\b.{0,80}\b(vulnerability|severity)\b|\b(vulnerability|severity)\b.{0,80}\bcritical\b"
ADVISORY_PATH = r"(?i)/(advisor(y|ies)|security-(advisory|bulletin|notice)|vuln/|vulnerability/|CVE-\d{4})"
PATCH_PATH = r"/(changeset|diff|patch)(/|$)"
#: exploits, uses, targets, drops, affects: triggers in order, with the confidence of each
_CVE, _FEW = r"CVE-[0-9]{4}-[0-9]{4,7}", r"\S+(?:\s+\S+){0,3}"
TRIGGERS = {
    "exploits": [(rf"(?i){_FEW}\s+exploits\s+{_CVE}", 0.9), (rf"(?i)exploit\s+for\s+{_CVE}", 0.6), (rf"(?i){_CVE}\s+exploited\s+by\s+\S", 0.9), (rf"(?i)PoC\s+for\s+{_CVE}", 0.6), (rf"(?is){_CVE}[^.]{{0,80}}remote\s+code\s+execution", 0.6)],
    "uses": [(r"(?i)\S\s+uses\s+\S", 0.85), (r"(?i)\S\s+deployed\s+\S", 0.85), (r"(?i)\S\s+attributed\s+to\s+\S", 0.85), (r"(?i)\S\s+leverages\s+\S", 0.85), (r"(?is)\S[^.]{0,50}?associated\s+with[^.]{0,50}?\S", 0.7)],
    "targets": [(r"(?i)\S\s+targets\s+\S", 0.85), (r"(?i)\S\s+targeting\s+\S", 0.85), (r"(?i)campaign\s+against\s+\S", 0.85), (r"(?i)attacks?\s+on\s+\S", 0.85)],
    "drops": [(r"(?i)\S\s+drops\s+\S", 0.9), (r"(?i)\S\s+delivers\s+\S", 0.9), (r"(?i)\S\s+downloads\s+\S", 0.9)],
    "affects": [(rf"(?i){_CVE}\s+affects\s+\S", 0.85), (rf"(?i)\S\s+vulnerable\s+to\s+{_CVE}", 0.85), (rf"(?i){_CVE}\s+in\s+\S", 0.85)],
}
#: words that carry a relation at confidence 0.5 when no trigger does
FALLBACK = {"exploits": ("exploit", "poc"), "uses": ("uses", "deployed", "attributed", "leverages", "associated with"), "targets": ("targets", "targeting", "campaign against", "attacks on"), "drops": (), "affects": ("affects", "vulnerable to", " in ")}
IMPLICIT_TARGET = r"(?i)campaign\s+against|attacks?\s+on"


def any_of(words: list[str]) -> str:
    """One case-insensitive alternation of whole words."""
    return r"(?i)\b(" + "|".join(words) + r")\b"
