"""Data links of documents: from what each route says to one block of links for each document.

Rows of links have doc, ord (the order in which routes and their links are met), resource, link_id, url, title, obtained_by,
relationship, section, frequency, matched_by, source_domain, routes (array), unfetched, id_scheme, publisher, category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import links

FILLED = ("url", "title", "section", "frequency", "matched_by", "source_domain")
SHOWN = ("resource", "id", "url", "title", "obtained_by", "relationship", "section", "frequency", "matched_by", "source_domain")
KEY_ORDER = ("pmid", "pmcid", "doi")


def confirmed(rows: DataFrame, key: list[str], candidates: Column, handles: DataFrame) -> DataFrame:
    """For each row's candidates, in order: the first that handles (doi, found) confirms, or 'pending' if one before it has no verdict yet."""
    each = rows.select(*key, F.posexplode(candidates).alias("turn", "doi"))
    known = handles.select(F.lower("doi").alias("_doi"), F.col("found"))
    j = each.join(known, F.lower("doi") == F.col("_doi"), "left")
    one = j.groupBy(*key).agg(F.min(F.when(F.col("found"), F.struct("turn", "doi"))).alias("yes"), F.min(F.when(F.col("found").isNull(), F.col("turn"))).alias("open"))
    wait = F.col("open").isNotNull() & (F.col("yes").isNull() | (F.col("open") < F.col("yes.turn")))
    return one.select(*key, F.when(~wait, F.col("yes.doi")).alias("chosen"), wait.alias("pending"))


def other_id(exact: Column, uri: Column, resource: Column) -> Column:
    """Struct of id and how it was got for an accession that isn't a DOI: exact, resolver, prefixed or cleaned; null if nothing sound is there."""
    parts = F.struct(exact.alias("exact"), resource.alias("resource"), links.prefixed(exact).alias("before"), links.cleaned(links.resolver_id(uri)).alias("local"), links.cleaned(exact).alias("bare"))
    return links.bound(parts, lambda v: _choice(*[v[c] for c in ("exact", "resource", "before", "local", "bare")]))


def _choice(exact: Column, resource: Column, before: Column, local: Column, bare: Column) -> Column:
    local_ok = (local != "") & links.sound(local, resource)
    keep_prefix = local_ok & (before != exact) & before.endswith(F.concat(F.lit(":"), local)) & links.sound(before, resource)
    pick = lambda x, how: F.struct(x.alias("id"), F.lit(how).alias("how"))
    return (
        F.when(links.sound(exact, resource), pick(exact, "exact"))
        .when(keep_prefix, pick(before, "resolver"))
        .when(local_ok, pick(local, "resolver"))
        .when((before != exact) & links.sound(before, resource), pick(before, "prefixed"))
        .when((bare != "") & links.sound(bare, resource), pick(bare, "cleaned"))
    )


def _resolved(rows: DataFrame, exact: Column, scheme: Column, publisher: Column, uri: Column, literature: Column, guess: Column, handles: DataFrame) -> DataFrame:
    """rows (doc, ord, ...) with resource, link_id, url and status: link, or why there is none. A DOI waits until handles has a verdict."""
    doi = F.lower(F.trim(F.coalesce(scheme, F.lit("")))) == "doi"
    r = rows.withColumns({"_exact": F.trim(F.coalesce(exact, F.lit(""))), "_doi": doi, "_scheme": scheme, "_publisher": publisher, "_uri": uri})
    r = r.withColumns({"_literature": literature, "_guess": guess})
    wanted = F.col("_doi") & (F.col("_exact") != "") & ~F.col("_literature") & F.col("_guess").isNotNull()
    r = r.withColumn("_candidates", F.when(wanted, links.doi_candidates(F.col("_exact"))))
    r = r.join(confirmed(r.where(F.size("_candidates") > 0), ["doc", "ord"], F.col("_candidates"), handles), ["doc", "ord"], "left")
    named = links.slug(F.when(F.col("_doi"), F.lit("DOI")).otherwise(F.col("_scheme")), F.col("_publisher"), F.when(F.col("_doi"), F.col("chosen")))
    r = r.withColumn("resource", F.when(F.col("_doi"), F.coalesce(named, F.col("_guess"))).otherwise(named))
    r = r.withColumn("_other", F.when(~F.col("_doi") & F.col("resource").isNotNull(), other_id(F.col("_exact"), F.col("_uri"), F.col("resource"))))
    status = (
        F.when(F.col("_exact") == "", "empty")
        .when(F.col("_doi") & F.col("_literature"), "reference")
        .when(F.col("_doi") & F.col("_guess").isNull(), "literature")
        .when(F.col("_doi") & (F.size("_candidates") == 0), "malformed")
        .when(F.col("pending"), "pending")
        .when(F.col("_doi") & F.col("chosen").isNull(), "unregistered")
        .when(~F.col("_doi") & F.col("resource").isNull(), "unmapped")
        .when(~F.col("_doi") & F.col("_other").isNull(), "malformed")
        .otherwise("link")
    )
    r = r.withColumn("status", status)
    ok = F.col("status") == "link"
    r = r.withColumn("link_id", F.when(ok, F.coalesce("chosen", "_other.id"))).withColumn("resource", F.when(ok, F.col("resource")))
    r = r.withColumns({"url": F.when(ok, links.canonical_url(F.col("resource"), F.col("link_id"), F.col("_uri"))), "how": F.when(ok, F.coalesce("_other.how", F.lit("doi"))), "repaired": ok & (F.col("link_id") != F.col("_exact"))})
    return r.withColumns({"id_scheme": F.col("_scheme"), "publisher": F.col("_publisher")}).drop(*[c for c in r.columns if c.startswith("_")], "chosen", "pending")


def from_annotations(rows: DataFrame, handles: DataFrame) -> DataFrame:
    """rows: doc, ord, exact, uri, sub_type, provider, section, frequency of text-mined accessions. Each row with its status, and a link where it is one."""
    scheme = F.coalesce("sub_type", links.scheme_of(F.col("uri")))
    cited = links.plain_name(F.col("section")).startswith("references")
    out = _resolved(rows, F.col("exact"), scheme, F.lit(None).cast("string"), F.col("uri"), cited, links.slug(F.lit("DOI"), F.lit(None).cast("string"), F.col("exact")), handles)
    provider = F.coalesce("provider", F.lit("Europe PMC"))
    by = F.when(F.lower(provider) == "biostudies", "tm_supplementary").otherwise("tm_accession")
    return out.withColumns({"publisher": provider, "title": F.lit(None).cast("string"), "obtained_by": by, "relationship": F.lit("References"), "category": F.lit(None).cast("string")})


def from_datalinks(rows: DataFrame, handles: DataFrame) -> DataFrame:
    """rows: doc, ord, id, id_scheme, publisher, url, title, obtained_by, relationship, category. A publisher names the resource of a DOI whose prefix isn't listed."""
    r = rows.withColumnsRenamed({"id": "_id", "id_scheme": "_kind", "publisher": "_owner", "url": "_own_url"})
    none = F.lit(None).cast("string")
    guess = F.coalesce(links.slug(F.lit("DOI"), F.col("_owner"), F.col("_id")), links.slug(F.col("_owner"), none, none), F.lit("doi"))
    out = _resolved(r, F.col("_id"), F.col("_kind"), F.col("_owner"), F.col("_own_url"), F.lit(False), guess, handles)
    return out.withColumns({"obtained_by": F.coalesce("obtained_by", F.lit("ext_links")), "section": none, "frequency": F.lit(None).cast("long")})


def from_entries(entries: DataFrame, papers: DataFrame, domains: DataFrame, apart: str | None = None) -> DataFrame:
    """Links of a dump of database entries to the papers they name.

    entries: domain, entry_id, title, page, values (array of publication values); papers: doc, pmid, pmcid, doi; domains: domain,
    resource, relationship. Both sides are exploded to (kind, value) and joined on it. An entry that names a paper by several keys is one
    link, kept with the strongest; entries without a sound id give none.
    """
    named = entries.withColumn("key", F.explode("values")).withColumn("key", links.publication(F.col("key"))).where("key.kind is not null").drop("values").distinct()
    own = papers.select("doc", F.explode(links.paper_keys(F.col("pmid"), F.col("pmcid"), F.col("doi"))).alias("key"))
    hits = own.join(named, "key").join(domains, "domain")
    home = hits.withColumn("home", links.canonical(F.col("resource"), F.col("entry_id")))
    moved = (F.col("home.resource") != F.col("resource")) | (F.col("home.id") != F.trim("entry_id"))
    page = F.when(~moved & (F.size(links.url_problems(F.col("page"))) == 0), F.col("page"))
    mark = [F.col(apart).alias("_apart")] if apart else []
    rows = home.select(*mark, "doc", F.col("home.resource").alias("resource"), F.col("home.id").alias("link_id"), page.alias("page"), "title", "relationship", F.col("key.kind").alias("matched_by"), "domain", "publisher")
    rows = rows.where(links.sound(F.col("link_id"), F.col("resource")))
    strength = F.array_position(F.array(*[F.lit(k) for k in KEY_ORDER]), F.col("matched_by"))
    best = rows.groupBy(*["_apart"] * len(mark), "doc", "resource", F.lower("link_id").alias("_low")).agg(F.min_by(F.struct("link_id", "page", "title", "relationship", "matched_by", "domain", "publisher"), F.struct(strength, "domain", "link_id")).alias("r"))
    return best.select("doc", "resource", "r.*").withColumn("url", F.coalesce("page", links.entry_url(F.col("resource"), F.col("link_id")))).drop("page").withColumnRenamed("domain", "source_domain")


def derived_entry(pmcid: Column) -> Column:
    """The repository entry that every article with supplementary files has; null without digits."""
    digits = F.regexp_replace(F.upper(F.trim(pmcid)), "^PMC", "")
    return F.when(digits.rlike("^[0-9]+$"), F.concat(F.lit("S-EPMC"), digits))


def rehomed(rows: DataFrame) -> DataFrame:
    """Links filed under their home resource; a link that moves gets the new resource's page."""
    r = rows.withColumn("_home", links.canonical(F.col("resource"), F.col("link_id")))
    moved = (F.col("_home.resource") != F.col("resource")) | (F.col("_home.id") != F.col("link_id"))
    return r.withColumns({"url": F.when(moved, links.entry_url(F.col("_home.resource"), F.col("_home.id"))).otherwise(F.col("url")), "resource": F.col("_home.resource"), "link_id": F.col("_home.id")}).drop("_home")


def hosted(rows: DataFrame) -> DataFrame:
    """ProteomeXchange ids of a document under the partner that a database says hosts them, the first of PXD_HOSTS if several do."""
    place = F.array_position(F.array(*[F.lit(h) for h in links.PXD_HOSTS]), F.col("resource"))
    pxd = F.col("link_id").rlike(links.PXD)
    claims = rows.where(pxd & F.col("source_domain").isNotNull() & (place > 0)).groupBy("doc", F.upper("link_id").alias("_pxd")).agg(F.min_by("resource", place).alias("_host"))
    r = rows.withColumn("_pxd", F.when(pxd & F.col("resource").isin(*links.PXD_HOSTS, "proteomexchange"), F.upper("link_id"))).join(claims, ["doc", "_pxd"], "left")
    moved = F.col("_host").isNotNull() & (F.col("_host") != F.col("resource"))
    return r.withColumns({"url": F.when(moved, links.entry_url(F.col("_host"), F.col("_pxd"))).otherwise(F.col("url")), "resource": F.coalesce("_host", "resource")}).drop("_pxd", "_host")


def merged(rows: DataFrame) -> DataFrame:
    """One row for each (doc, resource, id without case): the first link's, with what it lacks from later ones, and all routes."""
    given = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    first = F.min_by(F.struct(*[c for c in rows.columns if c not in ("doc", "resource", "routes", "unfetched", *FILLED)]), F.col("ord")).alias("_first")
    aggs = [F.min_by(c, F.when(given(c), F.col("ord"))).alias(c) for c in FILLED]
    routes = F.array_sort(F.array_distinct(F.flatten(F.collect_set("routes")))).alias("routes")  # routes are a handful
    one = rows.groupBy("doc", "resource", F.lower("link_id").alias("_low")).agg(first, *aggs, routes, F.max("unfetched").alias("unfetched"))
    return one.select("doc", "resource", "_first.*", *FILLED, "routes", "unfetched")


def resources_of(rows: DataFrame) -> DataFrame:
    """Per document and resource of merged links: count (with what a source counted but didn't return), first link's scheme and publisher, routes."""
    first = F.min_by(F.struct("id_scheme", "publisher", "obtained_by", "category"), F.col("ord")).alias("_f")
    routes = F.array_sort(F.array_distinct(F.flatten(F.collect_set("routes")))).alias("routes")
    return rows.groupBy("doc", "resource").agg(F.count("*").alias("held"), F.sum("unfetched").alias("unfetched"), first, routes).select("doc", "resource", "held", "unfetched", (F.col("held") + F.col("unfetched")).alias("count"), "_f.*", "routes")


def stored(rows: DataFrame, per_resource: int = 50, per_doc: int = 300) -> DataFrame:
    """The merged links that are kept, with their place: resources by most links, links as met. A document's window sees per_resource links of each resource at most."""
    rank = F.row_number().over(Window.partitionBy("doc", "resource").orderBy("ord", "link_id"))
    top = rows.withColumn("_rank", rank).where(F.col("_rank") <= per_resource)
    n = rows.groupBy("doc", "resource").agg(F.count("*").alias("_n"))
    place = F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("_n"), "resource", "_rank"))
    return top.join(n, ["doc", "resource"]).withColumn("place", place).where(F.col("place") <= per_doc).drop("_rank", "_n")


def blocks(rows: DataFrame, per_resource: int = 50, per_doc: int = 300) -> DataFrame:
    """doc, link_count, truncated, resources (array) and links (array): the block of each document from its links of all routes."""
    one = merged(rows)
    by = resources_of(one)
    listed = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("held")).alias("_order"), "resource", "count", "id_scheme", "publisher", "obtained_by", "category", "routes"))), lambda r: r.dropFields("_order"))
    summary = by.groupBy("doc").agg(listed.alias("resources"), F.sum("count").alias("link_count"), F.sum("unfetched").alias("_unfetched"))
    kept = stored(one, per_resource, per_doc).withColumnRenamed("link_id", "id")
    shown = F.transform(F.sort_array(F.collect_list(F.struct("place", *SHOWN))), lambda r: r.dropFields("place"))  # per_doc at most
    detail = kept.groupBy("doc").agg(shown.alias("links"))
    out = summary.join(detail, "doc", "left")
    return out.select("doc", "link_count", ((F.size("links") < F.col("link_count") - F.col("_unfetched")) | (F.col("_unfetched") > 0)).alias("truncated"), "resources", "links")


def malformed(block: DataFrame) -> DataFrame:
    """Links of blocks that may not be written: doc, resource, id, problems."""
    each = block.select("doc", F.explode("links").alias("l")).select("doc", "l.resource", "l.id", "l.url")
    why = F.concat(links.problems(F.col("id"), F.col("resource")), F.when(F.col("url").isNotNull(), F.transform(links.url_problems(F.col("url")), lambda p: F.concat(F.lit("url "), p))).otherwise(F.array().cast("array<string>")))
    return each.withColumn("problems", why).where(F.size("problems") > 0).drop("url")


def checked(block: DataFrame) -> DataFrame:
    """block as it is; the job fails at the first malformed link, before anything is committed."""
    bad = F.exists("links", lambda x: (F.size(links.problems(x["id"], x["resource"])) > 0) | (x["url"].isNotNull() & (F.size(links.url_problems(x["url"])) > 0)))
    return block.withColumn("links", F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.concat(F.lit("malformed link in "), F.col("doc").cast("string")))).otherwise(F.col("links")))


def registry_ids(papers: DataFrame, rows: DataFrame, resource: str) -> DataFrame:
    """doc and its registry id: the smallest that names it, '' if it could be looked up (by pmid or pmcid) and none does; others are left out."""
    own = rows.where(F.col("resource") == resource).groupBy("doc").agg(F.min("link_id").alias("_id"))
    able = F.size(links.paper_keys(F.col("pmid"), F.col("pmcid"), F.lit(None).cast("string"))) > 0
    return papers.join(own, "doc", "left").where(F.col("_id").isNotNull() | able).select("doc", F.coalesce("_id", F.lit("")).alias("registry_id"))


def merge_statistics(rows: DataFrame) -> DataFrame:
    """Counters of a merge from rows with status and route: per route and status the rows, the documents, and how many ids were repaired."""
    return rows.groupBy("route", "status").agg(F.count("*").alias("n"), F.countDistinct("doc").alias("documents"), F.count_if("repaired").alias("repaired"))


def gained(rows: DataFrame) -> DataFrame:
    """Per resource: documents where a database route added a link that no other route had, and where both found the same one."""
    one = rows.groupBy("doc", "resource", F.lower("link_id").alias("_low")).agg(F.max(F.col("source_domain").isNotNull()).alias("db"), F.max(F.col("source_domain").isNull()).alias("text"))
    per = one.where("db").groupBy("doc", "resource").agg(F.max(~F.col("text")).alias("new"), F.max("text").alias("both"))
    return per.groupBy("resource").agg(F.count_if("new").alias("gained"), F.count_if("both").alias("confirmed"))


def compared(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts of (doc, resource, id) in two builds: kept, added, removed, and moved where the id is filed under another resource."""
    side = lambda d, n: d.select("doc", F.lower("id").alias("id"), "resource").distinct().groupBy("doc", "id").agg(F.array_sort(F.collect_set("resource")).alias(n))
    j = side(old, "a").join(side(new, "b"), ["doc", "id"], "full_outer")
    state = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") == F.col("b"), "kept").otherwise("moved")
    return j.groupBy(state.alias("state")).agg(F.count("*").alias("links"), F.countDistinct("doc").alias("documents"))
