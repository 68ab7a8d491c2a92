"""Keyword tables as data: short alternations, names in alphabetical order."""

from __future__ import annotations


def terms(packed: str) -> list[str]:
    return packed.split("|")


CATEGORIES = {"vulnerability": 3, "exploit": 2, "phishing": 2, "ransomware": 3, "threat_actor": 3, "ioc": 4}  #: label -> number of its labelling functions

ADVISORY = terms("advisory|affected versions|patch available|remediation|security update")
EXPLOIT = terms("0day|exploit code|exploitation|metasploit|poc|proof of concept|shellcode|weaponized|zero-day")
PHISHING = terms("brand impersonation|credential harvesting|fake login|lure|phishing|phishing kit|social engineering|spear-phishing|spoofed")
RANSOM = terms("data leak site|decryptor|double extortion|encrypt|file encryption|ransom|ransom note|ransomware")
ACTOR_WORDS = terms("attributed to|campaign|espionage|intrusion set|nation-state|suspected state-sponsored|threat actor|threat group")
IOC_WORDS = terms("beacon|botnet|c2|callback|command and control|indicator of compromise|infrastructure|ioc") + ["malicious (?:domain|ip|url)"]
FAMILIES = terms("8base|akira|alphv|blackbasta|blackcat|clop|conti|cuba|hive|lockbit|medusa|play|ragnar locker|revil|rhysida|royal|vice society")
ACTORS = terms("charming kitten|cozy bear|equation group|fancy bear|hafnium|kimsuky|lazarus|mustang panda|nobelium|oceanlotus|sandworm|turla|winnti")

EXPLOIT_READY = terms("exploit code|poc|proof of concept|weaponized")
ACTIVE = terms("actively exploited|exploitation observed|in the wild|known exploited")

TRACKING = frozenset("campaign fbclid gclid mc_cid mc_eid ref source utm_campaign utm_content utm_medium utm_source utm_term".split())


def _aliases(packed: str) -> dict[str, str]:
    """'Name: alias, alias; ...' turned round; every name is an alias of itself unless marked with '!'."""
    out = {}
    for group in packed.split(";"):
        name, _, rest = group.strip().partition(":")
        own = name.lstrip("!")
        for alias in ([] if name[0] == "!" else [own.lower()]) + [a.strip() for a in rest.split(",") if a.strip()]:
            out[alias] = own
    return out


VENDORS = _aliases(
    "Adobe: adobe systems; Amazon; !Amazon Web Services: aws; Apple: apple inc; Broadcom; Cisco: cisco systems; CrowdStrike; Fortinet: fortigate;"
    "Google: alphabet; Mandiant; Microsoft: ms, msft; Oracle: oracle corp; !Palo Alto Networks: palo alto, pan; SentinelOne; Sophos; VMware"
)
ACTOR_ALIASES = _aliases(
    "APT28: fancy bear, forest blizzard, sofacy; APT29: cozy bear, midnight blizzard, nobelium, the dukes; Charming Kitten: apt35, mint sandstorm;"
    "HAFNIUM: silk typhoon; Kimsuky: emerald sleet, velvet chollima; Lazarus Group: diamond sleet, hidden cobra, lazarus;"
    "Mustang Panda: bronze president; Sandworm: seashell blizzard, voodoo bear; Turla: secret blizzard, venomous bear"
)
MALWARE = _aliases(
    "BlackCat: alphv, noberus; Clop: cl0p; Cobalt Strike: cobaltstrike; Conti; Emotet; LockBit: lockbit 3.0, lockbit black; Mimikatz; Qakbot: qbot; REvil: sodinokibi; TrickBot"
)
SYSTEMS = terms("active directory|android|apache struts|chrome|confluence|exchange|ios|linux|log4j|outlook|sharepoint|windows|wordpress")

ALIAS_GROUPS = {"organization": VENDORS, "system": VENDORS, "threat_actor": ACTOR_ALIASES, "malware": MALWARE}

GITHUB_CODE = terms("gist.github.com|raw.githubusercontent.com")
MEDIA_HOSTS = terms("dailymotion.com|vimeo.com|youtu.be|youtube.com")
PASTE_HOSTS = terms("dpaste.org|hastebin.com|paste.debian.net|pastebin.com")
LIST_HOSTS = terms("mail-archive.com|marc.info|openwall.com|seclists.org")
GOV_HOSTS = terms("cert.europa.eu|cisa.gov|cyber.gov.au|ncsc.gov.uk|nvd.nist.gov")
ADVISORY_HOSTS = sorted(
    "debian.org oracle.com mozilla.org cert.org kb.cert.org jvn.jp jvndb.jvn.jp ubuntu.com access.redhat.com bugzilla.redhat.com bugzilla.mozilla.org bugs.chromium.org "
    "chromereleases.googleblog.com exploit-db.com msrc.microsoft.com packetstormsecurity.com portal.msrc.microsoft.com security.gentoo.org security.netapp.com support.apple.com zerodayinitiative.com".split()
)
HINTS = terms("cve-|patch|security advisory|security bulletin|security notice|security update|vulnerability")
