"""Answers of literature services, captured as JSON, as flat records. Schemas are given, nothing is inferred, no network is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.ids import clean_doi, clean_pmcid, clean_pmid, uuid5

#: One search result with all the fields that are read.
CORE = (
    "id string, source string, pmid string, pmcid string, doi string, title string, abstractText string, authorString string, pubYear string, journalTitle string, "
    "journalInfo struct<journal: struct<title: string>>, meshHeadingList struct<meshHeading: array<struct<descriptorName: string>>>, pubTypeList struct<pubType: array<string>>, "
    "keywordList struct<keyword: array<string>>, isOpenAccess string, inEPMC string, inPMC string, hasData string, firstPublicationDate string, bookOrReportDetails struct<publisher: string>"
)
ANNOTATIONS = "source string, extId string, pmcid string, annotations array<struct<exact: string, tags: array<struct<uri: string>>, subType: string, provider: string, section: string, frequency: long, fileName: string>>"
SCHOLIX = (
    "dataLinkList struct<Category: array<struct<Name: string, Section: array<struct<ObtainedBy: string, Linklist: struct<Link: array<struct<ObtainedBy: string, "
    "Target: struct<Identifier: struct<ID: string, IDScheme: string, IDURL: string>, Title: string, Publisher: struct<Name: string>>, RelationshipType: struct<Name: string>, PublicationDate: string>>>>>>>>"
)
#: Namespace of minted ids; a parameter of incoming().
NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


def strings(values: Column) -> Column:
    """A list without its nulls; null is empty."""
    return F.coalesce(F.array_compact(values), F.array().cast("array<string>"))


def mesh(list_: Column) -> Column:
    return strings(F.transform(list_["meshHeading"], lambda h: h["descriptorName"]))


def filled(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def raw_records(core: DataFrame, source: str, label: str = "unlabeled") -> DataFrame:
    """Search results (as CORE) as records of a source: clean ids, Y and N as booleans, lists without nulls."""
    year = F.when(F.col("pubYear").rlike("^[0-9]+$"), F.col("pubYear").cast("int"))
    return core.select(
        F.lit(source).alias("source_name"), F.lit(label).alias("label"), clean_pmcid(F.col("pmcid")).alias("pmcid"), clean_pmid(F.col("pmid")).alias("pmid"), clean_doi(F.col("doi")).alias("doi"),
        filled(F.col("title")).alias("title"), filled(F.col("abstractText")).alias("abstract"), F.col("journalInfo.journal.title").alias("journal"), filled(F.col("authorString")).alias("authors"), year.alias("year"),
        mesh(F.col("meshHeadingList")).alias("mesh_headings"), strings(F.col("pubTypeList.pubType")).alias("pub_types"), F.when(F.col("isOpenAccess") == "Y", True).when(F.col("isOpenAccess") == "N", False).alias("is_open_access"),
        strings(F.col("keywordList.keyword")).alias("keywords_author"), (F.coalesce(F.col("inEPMC"), F.lit("")) == "Y").__or__(F.coalesce(F.col("inPMC"), F.lit("")) == "Y").alias("fulltext_available"),
    )


def incoming(core: DataFrame, namespace: str = NAMESPACE) -> DataFrame:
    """Search results as staged rows with a minted pid; results without any identifier are left out. Lists are JSON text."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    pmcid, doi, pmid = filled(text("pmcid")), filled(F.lower(text("doi"))), filled(text("pmid"))
    key = F.coalesce(F.concat(F.lit("PMCID:"), pmcid), F.concat(F.lit("DOI:"), doi), F.concat(F.lit("PMID:"), pmid))
    plain = lambda c: F.coalesce(F.col(c), F.lit("")).alias
    yes = lambda c: F.when(F.col(c) == "Y", "True").otherwise("False")
    terms = F.filter(mesh(F.col("meshHeadingList")), lambda t: t != "")
    out = core.where(key.isNotNull()).select(
        uuid5(namespace, key).alias("pid"), text("pmid").alias("pmid"), text("pmcid").alias("pmcid"), text("doi").alias("doi"), plain("title")("title"), plain("abstractText")("abstract"), plain("authorString")("authors"), plain("pubYear")("year"),
        F.coalesce(filled(F.col("journalInfo.journal.title")), "journalTitle", F.lit("")).alias("journal"), F.to_json(terms).alias("mesh_headings"), F.to_json(strings(F.col("pubTypeList.pubType"))).alias("pub_types"), F.to_json(strings(F.col("keywordList.keyword"))).alias("keywords_author"),
        yes("isOpenAccess").alias("is_open_access"), yes("inEPMC").alias("fulltext_available"), F.when(F.coalesce("abstractText", F.lit("")) != "", "europepmc").otherwise("").alias("abstract_source"), plain("source")("epmc_source"), plain("firstPublicationDate")("first_publication_date"),
        F.when(filled(F.col("source")).isNotNull(), F.coalesce("id", F.lit(""))).otherwise("").alias("epmc_id"), F.when(F.col("source") == "PPR", F.coalesce(F.col("bookOrReportDetails.publisher"), F.lit(""))).otherwise("").alias("preprint_server"),
    )
    return out


def annotations(answers: DataFrame, requested: DataFrame, fetched_at: str) -> DataFrame:
    """One row for each requested (source, id): ok with its annotations, or absent. answers: rows as ANNOTATIONS."""
    from corvane.functions.links import scheme_of

    one = lambda a: F.struct(
        F.trim(F.coalesce(a["exact"], F.lit(""))).alias("exact"), F.get(a["tags"], F.lit(0))["uri"].alias("uri"), F.coalesce(a["subType"], scheme_of(F.get(a["tags"], F.lit(0))["uri"])).alias("sub_type"), a["provider"].alias("provider"),
        filled(F.trim(F.regexp_replace(a["section"], r"\s*\(https?://[^)]*\)\s*$", ""))).alias("section"), a["frequency"].alias("frequency"),
    )
    got = answers.select(F.coalesce("source", F.lit("")).alias("source"), F.coalesce("extId", F.lit("")).alias("id"), F.transform(F.coalesce("annotations", F.from_json(F.lit("[]"), answers.schema["annotations"].dataType)), one).alias("annotations"), F.lit(True).alias("_hit"))
    got = got.groupBy("source", "id").agg(F.last("annotations").alias("annotations"), F.first("_hit").alias("_hit"))
    j = requested.select("source", "id").join(got, ["source", "id"], "left")
    return j.select("source", "id", F.lit(fetched_at).alias("fetched_at"), F.when(F.col("_hit"), "ok").otherwise("absent").alias("status"), "annotations")


def datalinks(answers: DataFrame) -> DataFrame:
    """Links of answers (doc and the fields of SCHOLIX), flattened over categories and sections; a link without an id is left out. Any level may be missing."""
    c = answers.select("doc", F.posexplode("dataLinkList.Category").alias("_c", "c"))
    s = c.select("doc", "_c", F.col("c.Name").alias("category"), F.posexplode("c.Section").alias("_s", "s"))
    link = s.select("doc", "_c", "category", "_s", F.col("s.ObtainedBy").alias("by"), F.posexplode("s.Linklist.Link").alias("_l", "l"))
    t = F.col("l.Target")
    out = link.select("doc", "_c", "_s", "_l", "category", F.coalesce("l.ObtainedBy", "by").alias("obtained_by"), F.trim(F.coalesce(t["Identifier"]["ID"], F.lit(""))).alias("id"), t["Identifier"]["IDScheme"].alias("id_scheme"), filled(t["Identifier"]["IDURL"]).alias("url"), filled(t["Title"]).alias("title"), t["Publisher"]["Name"].alias("publisher"), F.col("l.RelationshipType.Name").alias("relationship"))
    return out.where("id <> ''")


def textmined(rows: DataFrame, identities: DataFrame, kind: str) -> DataFrame:
    """Accessions of bulk files (accession, pmcid, ext_id, source) by the record they belong to: by (source, id), else by pmcid; others are left out."""
    known = identities.select("source", F.col("id").alias("ext_id")).distinct().withColumn("_hit", F.lit(True))
    by_pmcid = identities.where("pmcid is not null and pmcid <> ''").groupBy("pmcid").agg(F.max(F.struct("source", "id")).alias("_p"))
    j = rows.select(*[F.trim(c).alias(c) for c in ("accession", "pmcid", "ext_id", "source")]).join(known, ["source", "ext_id"], "left").join(by_pmcid, "pmcid", "left")
    home = F.when(F.col("_hit"), F.struct("source", F.col("ext_id").alias("id"))).otherwise(F.col("_p"))
    return j.select(home.alias("h"), "accession").where("h is not null").groupBy("h.source", "h.id").agg(F.array_sort(F.collect_set(F.struct(F.lit(kind).alias("kind"), "accession"))).alias("accessions"))
