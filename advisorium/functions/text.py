"""Identifier and text functions: Column in, Column out, all inside code generation."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifier and score patterns.
CVE_FULL = r"^(?i:CVE-)?(\d{4}-\d{4,})$"
CVE_ANY = r"(?i)(CVE-\d{4}-\d{4,})"
CVE_BOUNDED = r"(?i)\b(CVE-\d{4}-\d{4,})\b"
CVE_SHORT = r"(?i)(CVE-\d{4}-\d{4,8})"
VULN_ID = r"^([A-Za-z]+)-(.+)$"
CWE = r"(?i)(CWE-\d+)"
URL = r"(https?://[^\s\"'<>]+)"
CVSS_SCORE = r"(?i)(?:CVSS|score)[^0-9]{0,12}(\d{1,2}(?:\.\d)?)"
CVSS_VECTOR = r"(CVSS:\d\.\d/[A-Za-z:/]+[A-Za-z])"
TRANSIENT_STATUS = (429, 500, 502, 503, 504, 521)
# Marks of firewall challenge pages and of their response header.
FIREWALL_MARKS = [
    "_waf_", 'id="renderdata"', "id='renderdata'", "sigchl", "punish-type", "__jsl_clearance", "jsl_clearance", "x-via-jsl", "jiasule", "yunaq", "eo-bot-js-token",
    "eojschallengesdk", "gcaptcha.eo.gtimg.com", "tencent cloud edgeone",
]
PUNISH_HEADERS = ["Punish-Type", "punish-type"]


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def group(c: Column, pattern: str, number: int) -> Column:
    """A regular-expression group; null where nothing matches."""
    return F.nullif(F.regexp_extract(c, pattern, number), F.lit(""))


def cve_normalize(c: Column) -> Column:
    """The bare code of a full CVE identifier, with or without prefix; else null."""
    return group(F.trim(c), CVE_FULL, 1)


def cve_canonical(c: Column) -> Column:
    return F.concat(F.lit("CVE-"), cve_normalize(c))


def cve_extract(c: Column, pattern: str = CVE_ANY) -> Column:
    """All identifiers of a text, upper case, each once in first-seen order."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(1))
    return F.array_distinct(F.transform(found, F.upper))


def collect_cves(raw: Column) -> Column:
    """Canonical identifiers of an array in order of priority, each once; the first is the primary one."""
    return F.array_distinct(F.array_compact(F.transform(raw, cve_canonical)))


def vuln_id_parse(c: Column) -> Column:
    """struct(type, code, key, display); null where either part is missing."""
    kind, code = F.upper(group(F.trim(c), VULN_ID, 1)), group(F.trim(c), VULN_ID, 2)
    made = F.struct(kind.alias("type"), code.alias("code"), F.concat_ws(":", kind, code).alias("key"), F.concat_ws("-", kind, code).alias("display"))
    return F.when(kind.isNotNull() & code.isNotNull(), made)


def identity_key(kind: Column, code: Column) -> Column:
    return F.concat(F.lower(kind), F.lit(":"), code)


def canonical_id(c: Column) -> Column:
    """A stored identifier with its prefix in lower case."""
    return F.when(c.contains(":"), F.concat(F.lower(F.substring_index(c, ":", 1)), F.lit(":"), F.regexp_replace(c, "^[^:]*:", ""))).otherwise(c)


def text_clean(c: Column) -> Column:
    """White space, no-break spaces and byte order marks collapse to one space; trimmed."""
    return F.trim(F.regexp_replace(c, "[\\s\u00a0\ufeff\u3000]+", " "))


def text_clean_lines(c: Column) -> Column:
    """Each line cleaned, blank ones dropped."""
    return F.array_join(F.filter(F.transform(F.split(c, r"\r\n|\n|\r"), text_clean), lambda x: x != ""), "\n")


def text_compact(c: Column) -> Column:
    return F.regexp_replace(c, "[\\s\u00a0\ufeff\u3000]+", "")


def key_slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def html_strip(c: Column) -> Column:
    """Tags out, the common references decoded, white space collapsed."""
    bare = F.regexp_replace(c, "<[^>]*>", " ")
    for name, value in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(name), F.lit(value))
    return text_clean(bare)


def url_extract(c: Column, anchors: Column | None = None) -> Column:
    """Anchors first, then the addresses of the text without trailing punctuation; each once."""
    found = F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(URL), F.lit(1)), lambda u: F.regexp_replace(u, r"[).,;，。]+$", ""))
    return F.array_distinct(F.concat(anchors, found) if anchors is not None else found)


def _without_dots(path: Column) -> Column:
    """A path with its . and .. segments worked off; .. above the root is the root."""
    last = F.regexp_extract(path, r"/(\.\.?)$", 1) != ""  # such a path ends in a slash
    segments = F.filter(F.split(path, "/"), lambda x: x != ".")
    step = lambda done, x: F.when(x != "..", F.concat(done, F.array(x))).when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
    kept = F.aggregate(F.slice(segments, 2, 1_000_000), F.array(F.lit("")), step)
    worked = F.concat(F.array_join(kept, "/"), F.when(last | (F.size(kept) == 1), "/").otherwise(""))
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), worked).otherwise(path)


def url_resolve(c: Column, base: str) -> Column:
    """A reference as an absolute address, as RFC 3986 resolves it against ``base``: //host, /path, ../path, ?query and #fragment."""
    parts = urlsplit(base)
    origin, folder = f"{parts.scheme}://{parts.netloc}", parts.path.rpartition("/")[0] + "/"
    here = origin + (parts.path or "/")
    tail = F.regexp_extract(c, r"^[^?#]*(.*)$", 1)
    joined = lambda path: F.concat(F.lit(origin), _without_dots(path), tail)
    path = F.regexp_extract(c, r"^([^?#]*)", 1)
    query = f"?{parts.query}" if parts.query else ""
    return (
        F.when(c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), c).when(c.startswith("//"), F.concat(F.lit(f"{parts.scheme}:"), c)).when(c.startswith("/"), joined(path))
        .when(c.startswith("?"), F.concat(F.lit(here), c)).when((c == "") | c.startswith("#"), F.concat(F.lit(here + query), c)).otherwise(joined(F.concat(F.lit(folder), path)))
    )


def url_canonical(c: Column, base: str, hosts: list[str] | None = None, paths: list[str] | None = None) -> Column:
    """Absolute address without query, fragment and final slash; null off the host list, and where its path begins with none of ``paths``."""
    bare = F.regexp_replace(F.regexp_replace(url_resolve(c, base), r"[?#].*$", ""), "/+$", "")
    host, path = F.lower(F.regexp_extract(bare, r"^https?://([^/:]+)", 1)), F.regexp_extract(bare, r"^https?://[^/]*(.*)$", 1)
    test = F.lit(True)
    if hosts is not None:
        test = test & host.isin(hosts)
    if paths is not None:
        test = test & F.array_contains(F.transform(F.array(*[F.lit(p) for p in paths]), lambda p: path.startswith(p)), True)
    return bare if hosts is None and paths is None else F.when(test, bare)


def url_param(c: Column, name: str) -> Column:
    """A query parameter, its name in any case; null where it is missing or not all digits."""
    return group(c, rf"(?i)[?&]{name}=(\d+)(?:[&#]|$)", 1).cast("long")


def title_split(c: Column) -> Column:
    """struct(code, kind, status, rest) of titles like 'CODE: rest', 'kind (A26-01-02): rest', '【status】rest' and 'CVE-x rest'."""
    code = F.coalesce(
        group(c, r"^([A-Z][A-Z0-9]*-[0-9][0-9-]*): ", 1), group(c, r"^[^()]+\(([A-Z]\d{2}-\d{2}-\d{2})\): ", 1), group(c, r"^(CVE-\d{4}-\d{4,}) ", 1)
    )
    kind, status = group(c, r"^([^()]+) \([A-Z]\d{2}-\d{2}-\d{2}\): ", 1), group(c, "^【([^】]+)】", 1)
    rest = F.regexp_replace(c, r"^(?:[A-Z][A-Z0-9]*-[0-9][0-9-]*: |[^()]+\([A-Z]\d{2}-\d{2}-\d{2}\): |【[^】]+】|CVE-\d{4}-\d{4,} )", "")
    return F.struct(code.alias("code"), kind.alias("kind"), status.alias("status"), rest.alias("rest"))


def list_split(c: Column) -> Column:
    """Lines, then commas, semicolons, 'and' and ideographic separators; blanks and n/a dropped."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"[\n,;，；、]|\band\b"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: (x != "") & ~F.lower(x).isin("na", "n/a"))


def cvss_parse(c: Column) -> Column:
    """struct(score, vector): a vector in a link parameter gets the 3.1 prefix where it has none."""
    score = group(c, CVSS_SCORE, 1).cast("double")
    linked = group(c, r"[?&]vector=([A-Za-z:/.0-9]+)", 1)
    vector = F.coalesce(group(c, CVSS_VECTOR, 1), F.when(linked.startswith("CVSS:"), linked).when(linked.isNotNull(), F.concat(F.lit("CVSS:3.1/"), linked)))
    return F.struct(F.when(score <= 10, score).alias("score"), vector.alias("vector"))


def cwe_extract(c: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(CWE), F.lit(1)), F.upper))


def slice_between(c: Column, label: str, stops: list[str]) -> Column:
    """The text behind a label up to the first stop label; null without the label."""
    at = F.locate(label, c)
    rest = F.substr(c, at + len(label))
    ends = F.filter(F.array(*[F.locate(s, rest) for s in stops]), lambda p: p > 0)
    return F.when(at > 0, F.trim(F.when(F.size(ends) > 0, F.substr(rest, F.lit(1), F.array_min(ends) - 1)).otherwise(rest)))


def record_path(code: Column) -> Column:
    """Storage path of a CVE record: year, thousand, file."""
    year, number = F.split(code, "-")[0], F.split(code, "-")[1]
    return F.concat(year, F.lit("/"), F.floor(number.cast("long") / 1000).cast("string"), F.lit("xxx/CVE-"), code, F.lit(".json"))


def detail_url(provider: Column, code: Column) -> Column:
    return (
        F.when(provider == "nvd", F.concat(F.lit("https://nvd.nist.gov/vuln/detail/CVE-"), F.url_encode(code)))
        .when(provider == "github_advisory", F.concat(F.lit("https://github.com/advisories/"), F.url_encode(code)))
        .when(provider == "fortiguard", F.concat(F.lit("https://www.fortiguard.com/psirt/"), F.url_encode(code)))
    )


def uri_redact(c: Column) -> Column:
    """The password of a connection address is masked, the user kept."""
    return F.regexp_replace(c, r"([a-z][a-z0-9+.-]*://[^:/@\s]+):[^@\s]*@", "$1:***@")


def captcha_gate(html: Column) -> Column:
    """True for pages that show an inline picture and ask for what it says."""
    low = F.lower(html)
    return F.coalesce(low.contains("data:image") & low.rlike("验证码|type=(\"text\"|'text')"), F.lit(False))


def page_blocked(html: Column, headers: Column | None = None) -> Column:
    """True for firewall challenges: by a header of ``headers`` (a map), else by a mark in a page without a table; a captcha gate is none."""
    low = F.lower(html)
    marked = F.coalesce(low.rlike("|".join(m.replace(".", "[.]") for m in FIREWALL_MARKS)) & ~low.contains("<table"), F.lit(False))
    if headers is not None:
        punished = [F.coalesce(F.try_element_at(headers, F.lit(h)), F.lit("")) != "" for h in PUNISH_HEADERS]
        marked = F.coalesce(punished[0] | punished[1], F.lit(False)) | marked
    return ~captcha_gate(html) & marked


def failure_transient(status: Column, error: Column) -> Column:
    """True for statuses that pass by themselves, read from the error text where missing; a failed fetch without status counts."""
    code = F.coalesce(status.cast("int"), group(error, r"HTTP (\d{3})", 1).cast("int"))
    return F.coalesce(code.isin(*TRANSIENT_STATUS), error.startswith("Failed to fetch"), F.lit(False))
