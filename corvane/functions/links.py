"""Links and publication values as Column functions."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, hosts, accession rules and page addresses of public repositories.
TERMINATOR = r'[\s"“”„‘’«»（）［］｛｝，。；：、！？]|</'
TRAILING = (".", ",", ";", ":", "'", '"', "!", "?")
PAIRS = ((")", "("), ("]", "["), ("}", "{"), (">", "<"))
BAD_FIRST, BAD_LAST = r"^[(\[{<'\"]", r"[.,;:\]}>'\"]$"
DOI = r"^10\.[0-9]{4,9}/\S+$"
RRID = r"^RRID:[A-Za-z]+[_:]\S+$"
HOST_SCHEMES = (
    ("gisaid.org", "gisaid"),
    ("omim.org", "omim"),
    ("proteinatlas.org", "hpa"),
    ("ebi.ac.uk/pdbe/emdb/empiar", "empiar"),
    ("ebi.ac.uk/pdbe/emdb", "emdb"),
    ("ebi.ac.uk/emdb", "emdb"),
    ("ebi.ac.uk/pdbe", "pdb"),
    ("rcsb.org", "pdb"),
    ("ebi.ac.uk/ena", "ena"),
    ("ebi.ac.uk/biostudies", "biostudies"),
    ("ncbi.nlm.nih.gov/geo", "geo"),
    ("ncbi.nlm.nih.gov/snp", "refsnp"),
    ("uniprot.org", "uniprot"),
    ("clinicaltrials.gov", "clinicaltrials"),
)
#: Pattern, home resource, how the id is written there (prefix before the group, and its case).
ACCESSIONS = (
    (r"(?i)^E-GEOD-([0-9]+)$", "geo", "GSE", None),
    (r"(?i)^(phs[0-9]{6})(?:\.v[0-9]+\.p[0-9]+)?$", "dbgap", "", "lower"),
    (r"(?i)^((?:BIOMD|MODEL)[0-9]{10})$", "biomodels", "", "upper"),
    (r"(?i)^(EMPIAR-[0-9]+)$", "empiar", "", "upper"),
    (r"(?i)^(S-BIAD[0-9]+)$", "bioimage_archive", "", "upper"),
    (r"(?i)^(S-EPMC[0-9]+)$", "biostudies", "", "upper"),
    (r"(?i)^(MSV[0-9]{9})$", "massive", "", "upper"),
    (r"(?i)^(MTBL[SC][0-9]+)$", "metabolights", "", "upper"),
)
PXD, PXD_HOSTS = r"(?i)^PXD[0-9]{6}$", ("pride", "iprox", "jpost", "panorama")
PAGES = {
    "biotools": "https://bio.tools/{}",
    "bioproject": "https://www.ebi.ac.uk/ena/browser/view/{}",
    "ena": "https://www.ebi.ac.uk/ena/browser/view/{}",
    "eva": "https://www.ebi.ac.uk/ena/browser/view/{}",
    "geo": "https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc={}",
    "arrayexpress": "https://www.ebi.ac.uk/biostudies/arrayexpress/studies/{}",
    "expression_atlas": "https://www.ebi.ac.uk/gxa/sc/experiments/{}",
    "pride": "https://www.ebi.ac.uk/pride/archive/projects/{}",
    "iprox": "https://proteomecentral.proteomexchange.org/cgi/GetDataset?ID={}",
    "jpost": "https://proteomecentral.proteomexchange.org/cgi/GetDataset?ID={}",
    "panorama": "https://proteomecentral.proteomexchange.org/cgi/GetDataset?ID={}",
    "massive": "https://massive.ucsd.edu/ProteoSAFe/dataset.jsp?accession={}",
    "metabolights": "https://www.ebi.ac.uk/metabolights/{}",
    "pdb": "https://www.ebi.ac.uk/pdbe/entry/pdb/{}",
    "emdb": "https://www.ebi.ac.uk/emdb/{}",
    "empiar": "https://www.ebi.ac.uk/empiar/{}",
    "bioimage_archive": "https://www.ebi.ac.uk/biostudies/bioimages/studies/{}",
    "biostudies": "https://www.ebi.ac.uk/biostudies/studies/{}",
    "biomodels": "https://www.biomodels.org/{}",
    "dbgap": "https://www.ncbi.nlm.nih.gov/projects/gap/cgi-bin/study.cgi?study_id={}",
}
IDENTIFIERS_ORG = r"^(.*?identifiers\.org/(?:[^/:]+/)?[^/:]+:)(.+)$"
#: Names of resources as sources spell them (letters and digits only), and owners of DOI prefixes; both are parameters of slug().
ALIASES = {
    "geo": "geo", "geneexpressionomnibus": "geo", "arrayexpress": "arrayexpress", "rrid": "rrid", "pride": "pride", "iprox": "iprox", "pdb": "pdb", "pdbe": "pdb", "ena": "ena", "enaembl": "ena",
    "emdb": "emdb", "uniprot": "uniprot", "dryad": "dryad", "zenodo": "zenodo", "figshare": "figshare", "biostudies": "biostudies", "orphanet": "orphanet", "omim": "omim", "gisaid": "gisaid",
}
DOI_OWNERS = {"10.5061": "dryad", "10.5281": "zenodo", "10.6084": "figshare", "10.7910": "dataverse", "10.17632": "mendeley"}
SUFFIX_OWNERS = {"10.7937": (("TCIA", "tcia"), ("K9", "tcia"))}
_ENCODED = (("+", "%20"), ("*", "%2A"), ("%7E", "~"))


def any_of(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests, F.lit(False))


def bound(x: Column, use) -> Column:
    """use(x), with x evaluated once and not repeated in the plan."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def count_of(x: Column, c: str) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(c), F.lit("")))


def found(x: Column, pattern: str, group: int = 1) -> Column:
    """The group of a pattern, null where there is none."""
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def host(url: Column) -> Column:
    """Lower-case host without www. and port; empty where there is none."""
    return F.regexp_extract(F.lower(url), r"^[a-z]+://(www[.])?([^/?#:]+)", 2)


def encoded(x: Column, safe: str) -> Column:
    """Percent-encoded but for letters, digits, _.-~ and safe."""
    out = reduce(lambda s, p: F.replace(s, F.lit(p[0]), F.lit(p[1])), _ENCODED, F.url_encode(x))
    return reduce(lambda s, c: F.replace(s, F.lit(f"%{ord(c):02X}"), F.lit(c)), safe, out)


def decoded(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)


def _bared(x: Column) -> Column:
    """Without one character at an end that doesn't belong to an identifier, or as it is."""
    first, last = F.left(x, F.lit(1)), F.right(x, F.lit(1))
    closing = last.isin(*TRAILING) | any_of([(last == c) & (count_of(x, c) > count_of(x, o)) for c, o in PAIRS])
    opening = first.isin("'", '"') | any_of([(first == o) & (count_of(x, o) > count_of(x, c)) for c, o in PAIRS])
    return F.when(closing, F.left(x, F.length(x) - 1)).when(opening, F.substr(x, F.lit(2))).otherwise(x)


def cleaned(x: Column) -> Column:
    """A link id cut at the first white space, quote or full-width sign, without outer punctuation, quotes and unbalanced brackets. Null is empty."""
    cut = F.regexp_replace(F.trim(F.coalesce(x, F.lit(""))), f"(?Us)(?:{TERMINATOR}).*$", "")
    return bound(cut, _stripped)


def _stripped(cut: Column) -> Column:
    signs = F.length(cut) - F.length(F.regexp_replace(cut, r"[.,;:'\"!?()\[\]{}<>]", ""))  # as many steps at most
    return F.when(signs > 0, F.aggregate(F.sequence(F.lit(1), signs), cut, lambda acc, _: _bared(acc))).otherwise(cut)


def prefixed(x: Column) -> Column:
    """'RRID: AB_1' and 'ORPHA 4' with one colon and no space."""
    return F.regexp_replace(F.trim(F.coalesce(x, F.lit(""))), r"(?U)^([A-Za-z][A-Za-z0-9]*)\s*:?\s+(?=\S)", "$1:")


def resolver_id(uri: Column) -> Column:
    """The identifier in a resolver's address, null if it isn't one."""
    return F.coalesce(found(F.trim(uri), r"scicrunch\.org/resolver/(RRID:.+)$"), found(F.trim(uri), IDENTIFIERS_ORG, 2))


def problems(x: Column, resource: Column | None = None) -> Column:
    """Why an identifier may not be stored, as a list of names; none if it may."""
    return bound(F.struct(x.alias("x"), F.coalesce(resource, F.lit("")).alias("r") if resource is not None else F.lit("").alias("r")), lambda v: _why(v["x"], v["r"]))


def _why(x: Column, resource: Column) -> Column:
    rrid = F.upper(x).startswith("RRID:") | (resource == "rrid")
    doi = x.startswith("10.")
    why = [
        F.when(x.rlike(r"[^\x21-\x7e]"), "whitespace or non-ASCII"),
        F.when(x.rlike(BAD_FIRST), "leading punctuation"),
        F.when(x.rlike(BAD_LAST), "trailing punctuation"),
        F.when(any_of([count_of(x, c) != count_of(x, o) for c, o in PAIRS]), "unbalanced brackets"),
        F.when(doi & ~x.rlike(DOI), "not a DOI").when(doi & x.contains("XXX"), "placeholder"),
        F.when(rrid & ~x.rlike(RRID), "not an RRID"),
    ]
    return F.when(F.coalesce(x, F.lit("")) == "", F.array(F.lit("empty"))).otherwise(F.array_compact(F.array(*why)))


def url_problems(url: Column) -> Column:
    x = F.coalesce(url, F.lit(""))
    why = [F.when(~x.rlike("^https?://"), "not an http(s) URL"), F.when(x.rlike(r"[^\x21-\x7e]"), "whitespace or non-ASCII"), F.when(x.rlike(BAD_LAST), "trailing punctuation")]
    return F.array_compact(F.array(*why))


def sound(x: Column, resource: Column | None = None) -> Column:
    return F.size(problems(x, resource)) == 0


def doi_candidates(x: Column) -> Column:
    """DOIs that a text-mined string may stand for, the likeliest first: with glyphs repaired, without thousands separators, cut at a comma."""

    def forms(token: Column) -> Column:
        return F.array(cleaned(token), cleaned(F.regexp_replace(token, r"(?<=[0-9]),(?=[0-9]{3}(?:[^0-9]|$))", "")), cleaned(F.substring_index(token, ",", 1)))

    token = F.regexp_extract(F.trim(F.coalesce(x, F.lit(""))), r"(?s)(10\.[0-9]{4,9}/.*)$", 1)
    token = F.regexp_replace(F.regexp_replace(token, r"(?U)\s*[×✕✖]\s*", "x"), "[‐‑‒–—−]", "-")
    return F.array_distinct(F.filter(bound(token, forms), lambda d: (d != "") & sound(d)))


def canonical_url(resource: Column, link_id: Column, original: Column) -> Column:
    """The address stored with an id: the original if it is sound (and ends with a DOI or RRID), else the resolver's, else a rebuilt one, else null."""
    parts = F.struct(F.coalesce(resource, F.lit("")).alias("resource"), link_id.alias("id"), F.trim(F.coalesce(original, F.lit(""))).alias("own"))
    return bound(parts, lambda v: _canonical_url(v["resource"], v["id"], v["own"]))


def _canonical_url(resource: Column, link_id: Column, own: Column) -> Column:
    usable = (own != "") & (F.size(url_problems(own)) == 0)
    rrid = (resource == "rrid") | F.upper(link_id).startswith("RRID:")
    doi = link_id.rlike(DOI)

    def rebuilt(local: Column) -> Column:
        url = F.concat(F.regexp_extract(own, IDENTIFIERS_ORG, 1), local)
        return F.when((local != "") & sound(local) & (F.size(url_problems(url)) == 0), url)

    return (
        F.when(doi & usable & F.lower(decoded(own)).endswith(F.lower(link_id)), own)
        .when(doi, F.concat(F.lit("https://doi.org/"), encoded(link_id, "/:;()")))
        .when(rrid & usable & decoded(own).endswith(link_id), own)
        .when(rrid, F.concat(F.lit("https://scicrunch.org/resolver/"), encoded(link_id, ":")))
        .when(usable, own)
        .otherwise(bound(cleaned(F.regexp_extract(own, IDENTIFIERS_ORG, 2)), rebuilt))
    )


def plain_name(x: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]", "")


def scheme_of(uri: Column) -> Column:
    """The kind of id an address stands for: after identifiers.org/, else by host."""
    low = F.lower(F.coalesce(uri, F.lit("")))
    by_host = reduce(lambda w, p: w.when(low.contains(p[0]), p[1]), HOST_SCHEMES, F.when(F.lit(False), ""))
    return F.coalesce(found(F.coalesce(uri, F.lit("")), r"identifiers\.org/(?:ebi/)?([A-Za-z0-9_.-]+?)(?:[:/]|$)"), by_host)


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.from_json(F.lit(json.dumps(table)), "map<string, string>"), key)


def slug(scheme: Column, publisher: Column, doi: Column, aliases: dict[str, str] | None = None, owners: dict[str, str] | None = None) -> Column:
    """The resource a link belongs to; null for a DOI that no listed repository owns.

    By the scheme's name, else the publisher's (each also without and inside its brackets), else the DOI's prefix, else the scheme's own name.
    """
    parts = F.struct(*[F.coalesce(x, F.lit("")).alias(n) for n, x in (("scheme", scheme), ("publisher", publisher), ("doi", doi))])
    return bound(parts, lambda v: _slug(v["scheme"], v["publisher"], v["doi"], aliases or ALIASES, owners or DOI_OWNERS))


def _slug(scheme: Column, publisher: Column, doi: Column, aliases: dict[str, str], owners: dict[str, str]) -> Column:
    bracket = r"^(.*?)\s*\((.*?)\)\s*$"
    names = F.array(*[plain_name(n) for x in (scheme, publisher) for n in (x, F.regexp_extract(x, bracket, 1), F.regexp_extract(x, bracket, 2))])
    listed = F.get(F.array_compact(F.transform(names, lambda n: _lookup(aliases, F.when((n != "") & (n != "doi"), n)))), F.lit(0))
    prefix = F.regexp_extract(doi, r"(10\.[0-9]{4,9})/", 1)
    rest = F.upper(F.substring_index(doi, "/", -1))
    owned = F.coalesce(_lookup(owners, prefix), _lookup(aliases, plain_name(publisher)))
    for p, rules in SUFFIX_OWNERS.items():
        owned = F.when(prefix == p, reduce(lambda w, r: w.when(rest.startswith(r[0]), r[1]), rules, F.when(F.lit(False), "")).otherwise("doi")).otherwise(owned)
    own = F.nullif(plain_name(F.regexp_replace(scheme, r"^(.*?)\s*\(.*?\)\s*$", "$1")), F.lit(""))
    is_doi = (plain_name(scheme) == "doi") | (doi != "")
    return F.coalesce(listed, F.when(is_doi, owned).otherwise(F.coalesce(own, F.nullif(plain_name(publisher), F.lit("")))))


def canonical(resource: Column, link_id: Column) -> Column:
    """Struct of home resource and id as written there, whichever resource named an accession."""
    x = F.trim(F.coalesce(link_id, F.lit("")))
    home, named = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for pattern, to, before, case in ACCESSIONS:
        part = F.regexp_extract(x, pattern, 1)
        part = F.upper(part) if case == "upper" else F.lower(part) if case == "lower" else part
        home, named = home.when(x.rlike(pattern), to), named.when(x.rlike(pattern), F.concat(F.lit(before), part))
    return F.struct(home.otherwise(resource).alias("resource"), named.otherwise(x).alias("id"))


def entry_url(resource: Column, link_id: Column) -> Column:
    """The entry's page at its repository; null where no pattern is known or the address isn't sound."""
    x = encoded(link_id, ":")
    url = F.when(resource == "ega", F.concat(F.when(F.upper(link_id).startswith("EGAD"), "https://ega-archive.org/datasets/").otherwise("https://ega-archive.org/studies/"), encoded(link_id, "")))
    for name, page in PAGES.items():
        url = url.when(resource == name, F.concat(F.lit(page.removesuffix("{}")), x))
    return bound(url, lambda u: F.when(F.size(url_problems(u)) == 0, u))


def browse_url(resource: Column, pmid: Column) -> Column:
    return F.when((resource == "geo") & F.trim(pmid).rlike("^[0-9]+$"), F.concat(F.lit("https://www.ncbi.nlm.nih.gov/gds?LinkName=pubmed_gds&from_uid="), F.trim(pmid)))


def publication(x: Column) -> Column:
    """What a publication value of a repository is, and its clean form: a struct of kind (pmid, pmcid, doi) and value, both null if none."""
    text = F.regexp_replace(F.trim(decoded(F.coalesce(x, F.lit("")))), r"^[+\s]+|[+\s/]+$", "")
    text = F.regexp_replace(text, r"(?i)^(?:pubmed|pmid)\s*:\s*", "")
    return bound(F.coalesce(found(text, r"(?i)^(?:https?://)?(?:www\.)?(?:ncbi\.nlm\.nih\.gov/pubmed|pubmed\.ncbi\.nlm\.nih\.gov)/([0-9]+)$"), text), _publication)


def _publication(text: Column) -> Column:
    doi = F.trim(F.regexp_replace(text, r"(?i)^(?:doi:\s*|https?://(?:dx\.)?doi\.org/|(?:dx\.)?doi\.org/|\s+)+", ""))
    doi = F.regexp_replace(doi, r"(?<=/)\s+", "")
    kind = F.when(text.rlike("^[0-9]+$"), "pmid").when(text.rlike("(?i)^PMC[0-9]+$"), "pmcid").when(doi.rlike(DOI), "doi")
    value = lambda k: F.when(k == "pmid", text).when(k == "pmcid", F.upper(text)).when(k == "doi", F.lower(doi))
    return bound(kind, lambda k: F.struct(k.alias("kind"), value(k).alias("value")))


def paper_keys(pmid: Column, pmcid: Column, doi: Column) -> Column:
    """A paper's own keys, written as publication() writes them: an array of structs of kind and value."""
    c = F.upper(F.trim(F.coalesce(pmcid, F.lit(""))))
    keys = [
        F.when(F.trim(pmid).rlike("^[0-9]+$"), F.struct(F.lit("pmid").alias("kind"), F.trim(pmid).alias("value"))),
        F.when(c.rlike("^(PMC)?[0-9]+$"), F.struct(F.lit("pmcid").alias("kind"), F.concat(F.lit("PMC"), F.regexp_replace(c, "^PMC", "")).alias("value"))),
        F.when(F.lower(F.trim(doi)).rlike(DOI), F.struct(F.lit("doi").alias("kind"), F.lower(F.trim(doi)).alias("value"))),
    ]
    return F.array_compact(F.array(*keys))
