"""Translate between PMIDs and DOIs.

The `ids` table is the big side.  A batch request first reduces it with a
semi-join on its distinct keys, which Spark runs as a broadcast of the keys
while they fit under `spark.sql.autoBroadcastJoinThreshold` and as a
sort-merge join above it; only the hits are aggregated and joined back to the
requests.  (A plain left join would shuffle all of `ids`, because the left
side of a left join cannot be broadcast.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.ids import doi_fold, doi_key
from citeloom.functions.text import split_ids
from citeloom.operators.joins import join_keyed

# Status codes, messages and the miss marker of the responses.
FOUND, NOT_FOUND = 0, 2
SUCCESS = "success"
PMID_NOT_FOUND = "pmid value not found in database"
DOI_NOT_FOUND = "doi value not found in database"
DOIS_MESSAGE = "retrieving dois for pmids"
PMIDS_MESSAGE = "retrieving pmids for pmids"
MISS = -1


def _require(name: str, value) -> None:
    if value is None:
        raise ValueError(f'"{name}" parameter missing from request')


#: How DOIs are compared: the column of the comparison form, which the store keeps sorted out by Bloom filters.
#: `case` ignores case, `accents` case and accents (as accent-insensitive database collations do).
FORMS = {"case": ("doi_key", doi_key), "accents": ("doi_fold", doi_fold)}


def _form(ignore: str):
    if ignore not in FORMS:
        raise ValueError(f"ignore must be one of {sorted(FORMS)}, not {ignore!r}")
    return FORMS[ignore]


def with_doi_key(ids: DataFrame) -> DataFrame:
    """Add the comparison forms of the DOI that the table does not store already."""
    missing = {name: make(F.col("doi")) for name, make in FORMS.values() if name not in ids.columns}
    return ids.withColumns(missing) if missing else ids


def requests(spark: SparkSession, values: str | list, name: str) -> DataFrame:
    """Request rows (pos, <name>) of a comma separated text or a list."""
    if isinstance(values, str):
        one = spark.range(1).select(split_ids(F.lit(values)).alias("items"))
        return one.select(F.posexplode("items").alias("pos", name))
    rows = [(i, None if v is None else str(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"pos int, {name} string")


def _single(hits: DataFrame, value: Column, name: str, not_found: str) -> DataFrame:
    found = hits.agg(value.alias(name), F.count("*").alias("n_matches"))
    hit = F.col("n_matches") > 0
    return found.select(
        F.when(hit, F.lit(FOUND)).otherwise(F.lit(NOT_FOUND)).alias("status"),
        F.when(hit, F.lit(SUCCESS)).otherwise(F.lit(not_found)).alias("message"),
        name,
        "n_matches",
    )


def pmid_to_doi(ids: DataFrame, pmid) -> DataFrame:
    """One row (status, message, doi, n_matches); junk is simply not found."""
    _require("pmid", pmid)
    key = F.lit(str(pmid)).try_cast(ids.schema["pmid"].dataType)  # as in a batch
    hits = ids.filter(F.col("pmid") == key)
    return _single(hits, F.min("doi"), "doi", PMID_NOT_FOUND)


def doi_to_pmid(ids: DataFrame, doi, ignore: str = "case") -> DataFrame:
    """One row (status, message, pmid, n_matches) with the smallest PMID."""
    _require("doi", doi)
    name, make = _form(ignore)
    hits = with_doi_key(ids).filter(F.col(name) == make(F.lit(doi)))
    return _single(hits, F.min("pmid"), "pmid", DOI_NOT_FOUND)


def _batch(
    requests: DataFrame, table: DataFrame, key: str, value: Column, name: str
) -> DataFrame:
    """Left join of requests carrying `_key` to the table's `key` column."""
    wanted = requests.select("_key").filter(F.col("_key").isNotNull()).distinct()
    keyed = table.withColumn("_key", F.col(key))
    hits = (
        join_keyed(keyed, wanted, ["_key"], "left_semi")
        .groupBy("_key")
        .agg(value.alias(name), F.count("*").alias("n_matches"))
    )
    found = F.col("n_matches").isNotNull()
    return join_keyed(requests, hits, ["_key"], "left").select(
        *[c for c in requests.columns if c != "_key"],
        name,
        F.when(found, F.lit(FOUND)).otherwise(F.lit(NOT_FOUND)).alias("status"),
        F.coalesce("n_matches", F.lit(0)).alias("n_matches"),
    )


def pmids_to_dois(ids: DataFrame, requests: DataFrame) -> DataFrame:
    """DOI per request row; every request row comes back exactly once.

    `requests` has a `pmid` column of any type; its other columns (a position,
    a request id) are kept, so order by them to restore the request order.
    """
    if "pmid" not in requests.columns:
        raise ValueError('"pmids" parameter missing from request')
    kind = ids.schema["pmid"].dataType
    keyed = requests.withColumn("_key", F.col("pmid").try_cast(kind))
    return _batch(keyed, ids, "pmid", F.min("doi"), "doi")


def dois_to_pmids(ids: DataFrame, requests: DataFrame, ignore: str = "case") -> DataFrame:
    """Smallest PMID per requested DOI; the empty DOI never matches."""
    if "doi" not in requests.columns:
        raise ValueError('"dois" parameter missing from request')
    name, make = _form(ignore)
    keyed = requests.withColumn("_key", make(F.col("doi")))
    table = with_doi_key(ids).filter(F.col(name).isNotNull())
    return _batch(keyed, table, name, F.min("pmid"), "pmid")


def compat(result: DataFrame, name: str) -> DataFrame:
    """Add `value`: the translated id as text, `-1` for a miss."""
    miss = F.lit(str(MISS))
    return result.withColumn(
        "value",
        F.when(F.col("status") == FOUND, F.col(name).cast("string")).otherwise(miss),
    )


def batch_body(result: DataFrame, name: str, by: list[str]) -> DataFrame:
    """JSON response body per request, ids in request order.

    `by` identifies one request, whose ids all came from one comma separated
    text; the collected list is therefore no longer than that text.
    """
    plural = {"doi": "dois", "pmid": "pmids"}[name]
    message = {"doi": DOIS_MESSAGE, "pmid": PMIDS_MESSAGE}[name]
    hit = F.col("status") == FOUND
    # a miss is the number -1 next to DOI texts, so items are encoded one by one
    text = F.regexp_replace(F.to_json(F.array(F.col(name))), r"^\[|\]$", "")
    item = F.when(hit, text).otherwise(F.lit(str(MISS)))
    listed = F.array_sort(F.collect_list(F.struct("pos", item.alias("item"))))
    items = F.array_join(F.transform(listed, lambda x: x["item"]), ",")
    return result.groupBy(*by).agg(
        F.concat(
            F.lit('{"status":0,"message":"' + message + '","' + plural + '":['),
            items,
            F.lit("]}"),
        ).alias("body")
    )


def single_body(result: DataFrame, name: str) -> DataFrame:
    """JSON response body of a single lookup; absent ids are explicit nulls."""
    body = F.to_json(F.struct("status", "message", name), {"ignoreNullFields": "false"})
    return result.select(body.alias("body"))
