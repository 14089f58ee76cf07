"""The registered queries as SQL over the driver tables."""

from __future__ import annotations

from citeloom.sources import schemas

IDS = """
ids AS (
  SELECT o_orderkey AS pmid,
         CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '10.1000/X' || (o_orderkey // 2) END AS doi,
         o_orderpriority AS journal_name, CAST(o_custkey AS VARCHAR) AS journal_volume,
         CAST(year(o_orderdate) AS INTEGER) AS journal_year,
         CAST(month(o_orderdate) AS VARCHAR) AS journal_month
  FROM orders)"""

CHANGES = """
changes AS (
  SELECT user_id AS pmid, CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
         'pubmed24n' || lpad(CAST(day(ts) AS VARCHAR), 4, '0') || '.xml.gz' AS file_name,
         event_id AS seq, '10.2000/' || event_id AS doi, day(ts) AS d
  FROM events),
files AS (SELECT DISTINCT file_name FROM changes),
applied AS (SELECT DISTINCT file_name FROM changes WHERE d <= 20)"""

FILE_ORDER = """
winners AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY pmid
             ORDER BY file_name DESC, (op = 'D') DESC, seq DESC) AS rn
    FROM changes) WHERE rn = 1)"""

# the same order under the names of the XML corpus, which bound a file's rows
XML_CHANGES = CHANGES.replace(
    "lpad(CAST(day(ts) AS VARCHAR), 4, '0')",
    "lpad(CAST(day(ts) AS VARCHAR), 2, '0') || lpad(CAST(event_id // 1000000 AS VARCHAR), 6, '0')",
)

CHILDREN = """
children AS (
  SELECT l_orderkey AS pmid, l_linenumber, 'D' || l_partkey AS ui_id,
         l_returnflag || l_linestatus AS value
  FROM lineitem)"""

DOCS = """
docs AS (
  SELECT d.*, l.doc_id IS NOT NULL AS has_pd, l.quality, l.toxic, d.doc_id AS d,
         string_split(text, chr(10)) AS ls
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

LINES = (
    DOCS
    + """,
lines AS (
  SELECT * EXCLUDE (ls, text), len(ls) AS n, unnest(ls) AS line,
         CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS i
  FROM docs)"""
)

WORDS = (
    LINES
    + """,
words AS (
  SELECT *, unnest(string_split(line, ' ')) AS word,
         CAST(generate_subscripts(string_split(line, ' '), 1) - 1 AS INTEGER) AS j
  FROM lines)"""
)

DOI = """CASE WHEN NOT has_pd THEN '' WHEN quality = 1 THEN '10.1000/X' || d
          ELSE '10.1000/Y' || d END"""

MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
SEASONS = "['Winter','Spring','Summer','Fall']"

DOC_DATE = f"""
dated AS (
  SELECT *, CAST(1990 + d % 30 AS VARCHAR) AS y, {MONTHS}[d % 12 + 1] AS mon,
         {SEASONS}[d % 4 + 1] AS season, d % 6 AS kind
  FROM docs)"""

MEDLINE_DATE = """CASE kind WHEN 3 THEN y || ' ' || mon || '-' || mon WHEN 4 THEN y
                  WHEN 5 THEN y || ' ' || mon || ' ' || (d % 28 + 1) || '-30' END"""


def _ymd(value: str) -> str:
    return (
        f"(1990 + {value} % 30) || '-' || lpad(CAST({value} % 12 + 1 AS VARCHAR), 2, '0')"
        f" || '-' || lpad(CAST({value} % 28 + 1 AS VARCHAR), 2, '0')"
    )


def _q(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _single(request: str, condition: str, value: str, name: str, missing: str) -> str:
    return f"""
SELECT CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 2 END AS INTEGER) AS status,
       CASE WHEN count(*) > 0 THEN 'success' ELSE '{missing}' END AS message,
       {value} AS {name}, count(*) AS n_matches, '{request}' AS request
FROM ids WHERE {condition}"""


PMID_MISSING = "pmid value not found in database"
DOI_MISSING = "doi value not found in database"

PMID_REQUEST = "5,12,5,999999999,,abc,7, 8"
DOI_REQUEST = "10.1000/x2,10.1000/X2,10.1000/X4,10.9/none,,10.1000/x0"

BY_PMID = (
    "hits AS (SELECT pmid AS k, min(doi) AS doi, count(*) AS n FROM ids GROUP BY pmid)"
)
BY_DOI = """hits AS (SELECT lower(doi) AS k, min(pmid) AS pmid, count(*) AS n
         FROM ids WHERE doi <> '' GROUP BY lower(doi))"""


def _request(text: str) -> str:
    return f"""req AS (
  SELECT CAST(generate_subscripts(string_split('{text}', ','), 1) - 1 AS INTEGER) AS pos,
         unnest(string_split('{text}', ',')) AS x)"""


STATUS = "CAST(CASE WHEN k IS NULL THEN 2 ELSE 0 END AS INTEGER) AS status"
N_MATCHES = "coalesce(n, 0) AS n_matches"


def _bodies(prefix: str, hits: str, key: str, name: str, item: str, message: str) -> str:
    return _q(
        f"""{IDS}, {hits},
req AS (
  SELECT c_custkey AS request,
         string_split('{prefix}' || c_custkey || ',{prefix}' || c_custkey * 40 || ',{prefix}'
                      || c_custkey || ',{prefix}' || (c_custkey + 1) || ',', ',') AS items
  FROM customer),
item AS (SELECT request, generate_subscripts(items, 1) AS pos, unnest(items) AS x FROM req)""",
        f"""
SELECT request, '{{"status":0,"message":"{message}","{name}s":['
       || string_agg(CASE WHEN k IS NULL THEN '-1' ELSE {item} END, ',' ORDER BY pos) || ']}}' AS body
FROM item LEFT JOIN hits ON {key} = k GROUP BY request""",
    )


ORDER_DATES = f"""
base AS (
  SELECT o_orderkey AS pmid, CAST(o_orderkey % 10 AS INTEGER) AS form, o_orderdate AS t,
         strftime(o_orderdate, '%Y') AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
         CAST(day(o_orderdate) AS INTEGER) AS dd, CAST(quarter(o_orderdate) AS INTEGER) AS qq
  FROM orders),
parsed AS (
  SELECT pmid, form, y,
    CASE form WHEN 0 THEN m WHEN 1 THEN m WHEN 2 THEN (qq - 1) * 3 + 1 WHEN 3 THEN m
              WHEN 4 THEN 1 WHEN 5 THEN m WHEN 8 THEN (qq - 1) * 3 + 1 END AS pm,
    CASE form WHEN 0 THEN dd WHEN 5 THEN dd ELSE 1 END AS pd
  FROM base),
dates AS (
  SELECT pmid, form,
    CASE WHEN pm IS NOT NULL THEN y || '-' || lpad(CAST(pm AS VARCHAR), 2, '0') || '-'
         || lpad(CAST(pd AS VARCHAR), 2, '0') END AS pub_date,
    CASE form WHEN 6 THEN 'unknown_season' WHEN 7 THEN 'unknown_month'
              WHEN 9 THEN 'missing_pub_date' END AS problem
  FROM parsed)"""


ORACLE: dict[str, str] = {
    "lookup_pmid_doi": _q(
        IDS,
        _single("5", "pmid = 5", "min(doi)", "doi", PMID_MISSING)
        + "\nUNION ALL"
        + _single("999999999", "pmid = 999999999", "min(doi)", "doi", PMID_MISSING),
    ),
    "lookup_doi_pmid": _q(
        IDS,
        "\nUNION ALL".join(
            _single(x, f"lower(doi) = lower('{x}')", "min(pmid)", "pmid", DOI_MISSING)
            for x in ("10.1000/x2", "10.1000/X3", "10.9/none")
        ),
    ),
    "lookup_single_bodies": _q(
        IDS,
        """
SELECT '{"status":0,"message":"success","doi":"' || doi || '"}' AS body FROM ids WHERE pmid = 5
UNION ALL
SELECT '{"status":0,"message":"success","pmid":' || min(pmid) || '}' FROM ids
WHERE lower(doi) = '10.1000/x2'
UNION ALL
SELECT '{"status":2,"message":"doi value not found in database","pmid":null}'""",
    ),
    "lookup_batch_pmid_doi": _q(
        f"{IDS}, {BY_PMID}, {_request(PMID_REQUEST)}",
        f"""
SELECT pos, x AS pmid, doi, {STATUS}, {N_MATCHES},
       CASE WHEN k IS NULL THEN '-1' ELSE doi END AS value
FROM req LEFT JOIN hits ON try_cast(trim(x) AS BIGINT) = k""",
    ),
    "lookup_batch_doi_pmid": _q(
        f"{IDS}, {BY_DOI}, {_request(DOI_REQUEST)}",
        f"""
SELECT pos, x AS doi, pmid, {STATUS}, {N_MATCHES},
       CASE WHEN k IS NULL THEN '-1' ELSE CAST(pmid AS VARCHAR) END AS value
FROM req LEFT JOIN hits ON lower(x) = k AND x <> ''""",
    ),
    "lookup_table_pmid_doi": _q(
        f"{IDS}, {BY_PMID}",
        f"""
SELECT l_partkey AS pos, l_orderkey * 2 AS pmid, doi, {STATUS}, {N_MATCHES}
FROM lineitem LEFT JOIN hits ON l_orderkey * 2 = k""",
    ),
    "lookup_table_doi_pmid": _q(
        f"{IDS}, {BY_DOI}",
        f"""
SELECT l_partkey AS pos, '10.1000/x' || l_orderkey AS doi, pmid, {STATUS}, {N_MATCHES}
FROM lineitem LEFT JOIN hits ON '10.1000/x' || l_orderkey = k""",
    ),
    "lookup_bodies_pmid_doi": _bodies(
        "", BY_PMID, "try_cast(x AS BIGINT)", "doi", "'\"' || doi || '\"'",
        "retrieving dois for pmids",
    ),
    "lookup_bodies_doi_pmid": _bodies(
        "10.1000/x", BY_DOI, "nullif(lower(x), '')", "pmid", "CAST(pmid AS VARCHAR)",
        "retrieving pmids for pmids",
    ),
    "ids_upsert_snapshot": _q(
        CHANGES,
        """
SELECT pmid, op, file_name, seq, doi FROM (
  SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY file_name DESC, seq DESC) AS rn
  FROM changes) WHERE rn = 1 AND op = 'U'""",
    ),
    "latest_change_per_key": _q(
        f"{CHANGES},{FILE_ORDER}", "SELECT pmid, op, file_name, seq, doi FROM winners"
    ),
    "deleted_log": _q(CHANGES, "SELECT pmid, file_name FROM changes WHERE op = 'D'"),
    "cascade_children": _q(
        f"{CHANGES},{FILE_ORDER},{CHILDREN}",
        """
SELECT * FROM children c
WHERE NOT EXISTS (SELECT 1 FROM winners w WHERE w.op = 'D' AND w.pmid = c.pmid)""",
    ),
    "orphan_children": _q(
        f"{CHANGES},{CHILDREN}",
        """
SELECT * FROM children c
WHERE NOT EXISTS (SELECT 1 FROM changes p WHERE p.pmid = c.pmid)""",
    ),
    "children_with_parent": _q(
        f"{CHANGES},{CHILDREN}",
        "SELECT * FROM children c WHERE EXISTS (SELECT 1 FROM changes p WHERE p.pmid = c.pmid)",
    ),
    "files_unapplied": _q(
        CHANGES,
        "SELECT file_name FROM files WHERE file_name LIKE '%.gz' AND file_name NOT IN (SELECT file_name FROM applied)",
    ),
    "files_missing": _q(
        CHANGES,
        "SELECT file_name FROM files WHERE file_name NOT IN (SELECT file_name FROM applied)",
    ),
    "files_combined": _q(
        CHANGES, "SELECT file_name FROM applied UNION ALL SELECT file_name FROM files"
    ),
    "files_after": _q(
        CHANGES, "SELECT file_name FROM files WHERE file_name > 'pubmed24n0015.xml.gz'"
    ),
    "files_applied": _q(CHANGES, "SELECT file_name FROM applied"),
    "file_kind": _q(
        f"""{CHANGES},
both_years AS (SELECT file_name FROM files
         UNION ALL SELECT replace(file_name, 'pubmed24', 'pubmed23') FROM files)""",
        """
SELECT file_name, CAST(substr(file_name, 7, 2) AS INTEGER) AS file_year,
       CAST(regexp_extract(file_name, 'n([0-9]+)[.]xml', 1) AS BIGINT) AS file_number,
       CASE WHEN substr(file_name, 7, 2) <> '24' THEN 'reject'
            WHEN CAST(regexp_extract(file_name, 'n([0-9]+)[.]xml', 1) AS BIGINT) > 20 THEN 'update'
            ELSE 'baseline' END AS kind
FROM both_years""",
    ),
    "records_per_file": _q(
        CHANGES,
        """SELECT file_name, count(*) AS n_records, count(*) FILTER (op = 'U') AS n_doi
FROM changes GROUP BY file_name""",
    ),
    "main_rows": _q(
        f"{DOCS},{DOC_DATE}",
        f"""
SELECT CAST(d AS BIGINT) AS pmid, {DOI} AS doi,
  CASE WHEN has_pd AND toxic = 1 THEN 'S' || d ELSE '' END AS pii,
  CASE WHEN has_pd THEN 'PMC' || d ELSE '' END AS pmcid,
  CASE WHEN d % 3 <> 0 THEN {_ymd("d")} END AS date_completed,
  CASE WHEN d % 5 <> 0 THEN {_ymd("n_chars")} END AS date_revised,
  CASE WHEN d % 4 <> 0 THEN 'N' || d END AS issn_value,
  CASE WHEN d % 4 <> 0 THEN CASE WHEN d % 2 = 0 THEN 'Print' ELSE 'Electronic' END END AS issn_type,
  source AS journal_title,
  CASE WHEN d % 6 <> 5 THEN CAST(n_chars AS VARCHAR) END AS volume,
  CASE WHEN d % 5 <> 4 THEN CAST(d % 12 AS VARCHAR) END AS issue,
  y || '-' || lpad(CAST(CASE kind WHEN 2 THEN d % 4 * 3 + 1 WHEN 4 THEN 1 ELSE d % 12 + 1 END AS VARCHAR), 2, '0')
    || '-' || lpad(CAST(CASE WHEN kind IN (0, 5) THEN d % 28 + 1 ELSE 1 END AS VARCHAR), 2, '0') AS pub_date,
  lang AS iso_abbrev, text AS title,
  CASE WHEN lang <> 'en' THEN text ELSE '' END AS vernacular_title,
  CASE WHEN d % 3 <> 1 THEN n_chars || '-' || (n_chars + 5) ELSE '' END AS pages,
  CASE WHEN d % 2 = 0 THEN source || lang END AS coi,
  CASE WHEN d % 4 = 1 THEN CAST(len(ls) AS VARCHAR) ELSE 'None' END AS n_references,
  CAST(len(ls) AS INTEGER) AS n_chems, CAST(len(ls) AS INTEGER) AS n_supp_mesh,
  CAST(len(ls) AS INTEGER) AS n_mesh,
  CAST(CASE WHEN d % 13 = 12 THEN 0 ELSE len(ls) END AS INTEGER) AS n_authors,
  CAST(CASE WHEN d % 17 = 16 THEN 0 ELSE len(ls) END AS INTEGER) AS n_keyword_lists,
  CAST(CASE WHEN d % 17 = 16 THEN 0
       ELSE len(string_split(replace(text, chr(10), ' '), ' ')) END AS INTEGER) AS n_keywords,
  {MEDLINE_DATE} AS medline_date_raw
FROM dated""",
    ),
    "abstract_rows": _q(
        f"""{LINES},
parts AS (
  SELECT CAST(d AS BIGINT) AS pmid, i, n, line,
         CASE WHEN i % 5 <> 4 THEN 'P' || (i + 1) ELSE '' END AS label,
         CASE WHEN i % 3 <> 2 THEN 'RESULTS' ELSE '' END AS category
  FROM lines WHERE d % 11 <> 10)""",
        """
SELECT pmid, CAST(i + 1 AS INTEGER) AS element_id, label, category, line AS text
FROM parts WHERE n > 1
UNION ALL
SELECT pmid, CAST(0 AS INTEGER), 'full', 'full',
       CASE WHEN max(n) = 1 THEN max(line) ELSE string_agg(label || ': ' || line, chr(10) ORDER BY i) END
FROM parts GROUP BY pmid""",
    ),
    "author_rows": _q(
        LINES,
        """
SELECT CAST(d AS BIGINT) AS pmid, i AS auth_order, i % 4 = 3 AS is_collective,
  i = 0 AS is_first, i = n - 1 AS is_last, line AS last_name,
  CASE WHEN i % 4 <> 3 AND i % 2 = 0 THEN source ELSE '' END AS fore_name,
  CASE WHEN i % 4 <> 3 THEN lang ELSE '' END AS initials,
  CASE WHEN i % 4 <> 3 AND i % 3 = 0 THEN 'Jr' ELSE '' END AS suffix,
  CASE WHEN i % 2 = 0 THEN i || '-' || d ELSE '' END AS orcid,
  CASE WHEN i % 3 <> 2 THEN line ELSE '' END AS affiliation,
  CASE WHEN i % 3 <> 2 THEN 'r' || i ELSE '' END AS ringgold_id,
  CASE WHEN i % 3 <> 2 THEN 'i' || i ELSE '' END AS isni_id,
  CASE WHEN i % 3 <> 2 THEN 'g' || i ELSE '' END AS grid_id
FROM lines WHERE d % 13 <> 12""",
    ),
    "chem_rows": _q(
        LINES,
        "SELECT CAST(d AS BIGINT) AS pmid, d || '-' || i AS registry_number, line AS name, 'C' || i AS ui_id FROM lines",
    ),
    "comments_corrections_rows": _q(
        LINES,
        """
SELECT CAST(d AS BIGINT) AS pmid,
  CASE WHEN i % 2 = 0 THEN 'CommentIn' ELSE 'ErratumIn' END AS ref_type, line AS ref_source,
  CASE WHEN i % 3 = 0 THEN 'note ' || i ELSE '' END AS note,
  CASE WHEN i % 2 = 0 THEN CAST(d + i AS VARCHAR) ELSE '0' END AS ref_pmid
FROM lines""",
    ),
    "data_bank_rows": _q(
        WORDS,
        """
SELECT CAST(d AS BIGINT) AS pmid, d % 2 = 0 AS is_complete, 'B' || i AS name, word AS acc_number
FROM words WHERE i % 2 = 0
UNION ALL
SELECT CAST(d AS INTEGER), d % 2 = 0, 'B' || i, '' FROM lines WHERE i % 2 = 1""",
    ),
    "grants_rows": _q(
        LINES,
        """
SELECT CAST(d AS BIGINT) AS pmid, d % 3 = 0 AS is_complete,
  CASE WHEN i % 2 = 0 THEN 'G' || i ELSE '' END AS grant_id,
  CASE WHEN i % 3 <> 0 THEN 'A' || i ELSE '' END AS acronym, line AS agency, lang AS country
FROM lines""",
    ),
    "keywords_rows": _q(
        WORDS,
        """
SELECT CAST(d AS BIGINT) AS pmid, source || '-' || i AS owner, j % 2 = 0 AS is_major,
       word AS keyword
FROM words WHERE d % 17 <> 16""",
    ),
    "languages_rows": _q(
        DOCS,
        "SELECT CAST(d AS BIGINT) AS pmid, unnest([lang, 'und']) AS language FROM docs",
    ),
    "mesh_rows": _q(
        WORDS,
        """
SELECT CAST(d AS BIGINT) AS pmid, i AS heading_id, i % 2 = 0 AS is_major, 'D' || i AS ui_id,
       line AS value FROM lines
UNION ALL
SELECT CAST(d AS INTEGER), i, j % 3 = 0, 'Q' || j, word FROM words""",
    ),
    "notes_rows": _q(
        LINES,
        "SELECT CAST(d AS BIGINT) AS pmid, line AS text, CASE WHEN i % 2 = 0 THEN 'NLM' ELSE 'KIE' END AS owner FROM lines",
    ),
    "personal_names_rows": _q(
        LINES,
        """
SELECT CAST(d AS BIGINT) AS pmid, line AS last_name,
       CASE WHEN i % 2 = 0 THEN lang ELSE '' END AS fore_name, '' AS initials, '' AS suffix
FROM lines""",
    ),
    "pub_types_rows": _q(
        LINES, "SELECT CAST(d AS BIGINT) AS pmid, 'D' || i AS ui_id, line AS value FROM lines"
    ),
    "refs_rows": _q(
        WORDS,
        """
SELECT CAST(d AS BIGINT) AS pmid, CASE WHEN i % 2 = 0 THEN 'T' || i ELSE '' END AS list_title,
  i AS list_index, j AS ref_index, word AS citation,
  CASE WHEN j % 2 = 0 THEN CAST(j + 1 AS VARCHAR) ELSE '' END AS ref_pmid,
  CASE WHEN j % 2 = 0 THEN '10.3/' || word ELSE '' END AS ref_doi, '' AS ref_pii
FROM words WHERE has_pd""",
    ),
    "space_rows": _q(LINES, "SELECT CAST(d AS BIGINT) AS pmid, line AS mission FROM lines"),
    "supp_mesh_rows": _q(
        LINES,
        """
SELECT CAST(d AS BIGINT) AS pmid, CASE WHEN i % 2 = 0 THEN 'Disease' ELSE 'Protocol' END AS type,
       'C' || i AS ui_id, line AS value FROM lines""",
    ),
    "ids_rows": _q(
        f"{DOCS},{DOC_DATE}",
        f"""
SELECT CAST(d AS BIGINT) AS pmid, {DOI} AS doi, source AS journal_name,
  CASE WHEN d % 6 <> 5 THEN CAST(n_chars AS VARCHAR) ELSE '' END AS journal_volume,
  CAST(CASE WHEN kind < 3 THEN y ELSE '0' END AS INTEGER) AS journal_year,
  CASE WHEN d % 5 <> 4 THEN CAST(d % 12 AS VARCHAR) ELSE '' END AS journal_issue,
  CASE kind WHEN 0 THEN CAST(d % 12 + 1 AS VARCHAR) WHEN 1 THEN mon ELSE '' END AS journal_month
FROM dated""",
    ),
    "id_pairs": _q(DOCS, f"SELECT CAST(d AS BIGINT) AS pmid, {DOI} AS doi FROM docs"),
    "first_id_by_type": _q(
        DOCS,
        f"""
SELECT CAST(d AS BIGINT) AS pmid, {DOI} AS doi,
  CASE WHEN has_pd AND toxic = 1 THEN 'S' || d ELSE '' END AS pii,
  CASE WHEN has_pd THEN 'PMC' || d ELSE '' END AS pmcid FROM docs""",
    ),
    "pub_date_parse": _q(
        ORDER_DATES,
        """
SELECT pmid, form, pub_date,
  CASE WHEN form IN (3, 4, 5, 8) THEN '2000-01-01' ELSE pub_date END AS constant_date,
  problem, CAST(pub_date AS DATE) AS calendar_date
FROM dates""",
    ),
    "date_entries": _q(
        DOCS,
        f"""
SELECT CAST(d AS BIGINT) AS pmid, CASE WHEN d % 3 <> 0 THEN {_ymd("d")} END AS date_completed,
       CASE WHEN d % 5 <> 0 THEN {_ymd("n_chars")} END AS date_revised FROM docs""",
    ),
    "rejected_articles": _q(
        ORDER_DATES,
        """
SELECT CAST(pmid AS VARCHAR) AS pmid, 'bad_pub_date' AS reason, problem AS detail, true AS kept
FROM dates WHERE problem IS NOT NULL""",
    ),
    "store_rejects_keep_ids":
        "SELECT CAST(o_orderkey AS BIGINT) AS pmid, '10.9/' || o_orderkey AS doi FROM orders",
    "pmid_wide": """
SELECT o_orderkey + 3000000000 AS pmid, '10.9/' || (o_orderkey + 3000000000) AS doi,
  CAST(0 AS INTEGER) AS status, CAST(1 AS BIGINT) AS n_matches FROM orders""",
    "child_ordinals": """
SELECT l_orderkey AS pmid, 'D' || l_partkey AS ui_id, l_returnflag || l_linestatus AS value,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
    l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1
    AS BIGINT) AS ordinal
FROM lineitem""",
    "author_flags": """
SELECT conv_id AS pmid, turn AS auth_order, role = 'system' AS is_collective,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 AS is_first,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) = count(*) OVER (PARTITION BY conv_id) AS is_last,
  CAST(count(*) OVER (PARTITION BY conv_id) AS INTEGER) AS n_items, text AS last_name
FROM conversations""",
    "child_counts": """
SELECT o_orderkey AS pmid, CAST(count(l_orderkey) AS INTEGER) AS n_children
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""",
    "nested_citation": _q(
        f"{DOCS},{DOC_DATE}",
        f"""
SELECT CAST(d AS VARCHAR) AS pmid, '1' AS pmid_version, source AS owner, 'MEDLINE' AS status,
  CASE WHEN d % 2 = 0 THEN '1' END AS version_id,
  CASE WHEN d % 2 = 0 THEN y || '-01-01' END AS version_date,
  CASE WHEN d % 3 <> 0 THEN CAST(d % 12 + 1 AS VARCHAR) END AS completed_month,
  CASE WHEN d % 5 <> 0 THEN CAST(n_chars % 28 + 1 AS VARCHAR) END AS revised_day,
  CASE WHEN d % 4 <> 0 THEN CASE WHEN d % 2 = 0 THEN 'Print' ELSE 'Electronic' END END AS issn_type,
  CASE WHEN kind = 2 THEN season END AS season, {MEDLINE_DATE} AS medline_date,
  source AS journal_title, lang AS country, CAST(d AS VARCHAR) AS nlm_id,
  CAST(NULL AS VARCHAR) AS issn_linking,
  CASE WHEN d % 4 = 1 THEN CAST(len(ls) AS VARCHAR) END AS n_references,
  CASE WHEN d % 2 = 0 THEN source || lang END AS coi, lang || ',' || source AS subsets,
  'NLM/' || d AS other_ids
FROM dated""",
    ),
    "nested_article": _q(
        f"""{LINES},
trimmed AS (SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(13)) AS s FROM lines),
per AS (
  SELECT d,
    string_agg('pii/' || CASE WHEN i % 2 = 0 THEN 'Y' ELSE 'N' END || '/' || s, '|' ORDER BY i) AS locations,
    string_agg(CASE WHEN i % 5 <> 4 THEN 'P' || (i + 1) ELSE '~' END || '/' || s, '|' ORDER BY i) AS parts,
    string_agg(s || '/' || CASE WHEN i % 2 = 0 THEN source ELSE '~' END || '/'
      || CASE WHEN i % 2 = 0 THEN 'ORCID/' || d || '-' || i || ',ORCID/' || i || '-' || d ELSE '' END || '/'
      || CASE WHEN i % 3 <> 2 THEN '2/' || s || ',second' ELSE '0/' END, '|' ORDER BY i) AS authors
  FROM trimmed GROUP BY d)""",
        """
SELECT CAST(docs.d AS VARCHAR) AS pmid,
  trim(docs.text, chr(32) || chr(9) || chr(10) || chr(13)) AS title,
  CASE WHEN docs.d % 3 <> 1 THEN n_chars || '-' || (n_chars + 5) END AS pages, locations,
  (1990 + docs.d % 30) || '/1/' || (docs.d % 28 + 1) || '/Electronic' AS dates,
  CASE WHEN docs.d % 11 <> 10 THEN '(c) ' || source END AS copyright,
  CASE WHEN docs.d % 11 <> 10 THEN parts END AS parts,
  CASE WHEN docs.d % 13 <> 12 THEN authors ELSE '' END AS authors,
  lang || ',und' AS languages,
  CASE WHEN lang <> 'en' THEN trim(docs.text, chr(32) || chr(9) || chr(10) || chr(13)) END AS vernacular_title
FROM docs JOIN per ON docs.d = per.d""",
    ),
    "nested_terms": _q(
        f"""{WORDS},
w AS (
  SELECT d, i,
    string_agg('Q' || j || '/' || trim(word, chr(9) || chr(13)), ' ' ORDER BY j) AS quals,
    string_agg(trim(word, chr(9) || chr(13)), ' ' ORDER BY j) AS keys
  FROM words GROUP BY d, i),
per AS (
  SELECT l.d,
    string_agg(trim(line, chr(32) || chr(9) || chr(13)) || '=' || quals, '|' ORDER BY l.i) AS mesh,
    string_agg(source || '-' || l.i || '=' || keys, '|' ORDER BY l.i) AS keywords,
    string_agg(CASE WHEN l.i % 2 = 0 THEN 'CommentIn/' || (l.d + l.i) ELSE 'ErratumIn/~' END || '/'
      || CASE WHEN l.i % 3 = 0 THEN 'note ' || l.i ELSE '' END, '|' ORDER BY l.i) AS corrections,
    string_agg(l.d || '-' || l.i || '/' || trim(line, chr(32) || chr(9) || chr(13)) || '/C' || l.i, '|' ORDER BY l.i) AS chemicals,
    string_agg(CASE WHEN l.i % 2 = 0 THEN 'Disease' ELSE 'Protocol' END || '/C' || l.i || '/'
      || trim(line, chr(32) || chr(9) || chr(13)), '|' ORDER BY l.i) AS supplements
  FROM lines l JOIN w ON l.d = w.d AND l.i = w.i GROUP BY l.d)""",
        """
SELECT CAST(d AS VARCHAR) AS pmid, mesh, CASE WHEN d % 17 <> 16 THEN keywords ELSE '' END AS keywords,
       corrections, chemicals, supplements FROM per""",
    ),
    "nested_lists": _q(
        f"""{WORDS},
w AS (SELECT d, i, string_agg(trim(word, chr(9) || chr(13)), ' ' ORDER BY j) AS ws FROM words GROUP BY d, i),
t AS (SELECT l.*, ws, trim(line, chr(32) || chr(9) || chr(13)) AS s FROM lines l JOIN w ON l.d = w.d AND l.i = w.i)""",
        """
SELECT CAST(d AS VARCHAR) AS pmid,
  string_agg('O' || i || '/' || s, '|' ORDER BY i) AS other_abstracts,
  CASE WHEN d % 2 = 1 THEN string_agg(s, '|' ORDER BY i) END AS genes,
  CASE WHEN d % 2 = 0 THEN string_agg(CASE WHEN i % 2 = 0 THEN 'Y' ELSE 'N' END || '/' || s, '|' ORDER BY i) END AS investigators,
  string_agg(CASE WHEN i % 2 = 0 THEN 'NLM' ELSE 'KIE' END || '/' || s, '|' ORDER BY i) AS notes,
  string_agg(s, '|' ORDER BY i) AS missions,
  string_agg('B' || i || '=' || CASE WHEN i % 2 = 0 THEN ws ELSE '' END, '|' ORDER BY i) AS banks,
  string_agg(CASE WHEN i % 2 = 0 THEN 'G' || i ELSE '~' END || '/'
    || CASE WHEN i % 3 <> 0 THEN 'A' || i ELSE '~' END || '/' || s, '|' ORDER BY i) AS grants,
  string_agg('D' || i || '/' || s, '|' ORDER BY i) AS pub_types,
  string_agg(s || '/' || CASE WHEN i % 2 = 0 THEN lang ELSE '~' END, '|' ORDER BY i) AS names,
  CASE WHEN bool_and(has_pd) THEN string_agg('K' || i || '=id/' || s, '|' ORDER BY i) END AS objects,
  CASE WHEN bool_and(has_pd) THEN
    string_agg(CASE WHEN i % 2 = 0 THEN 'T' || i || '=' ELSE '' END || ws, '|' ORDER BY i) END AS "references"
FROM t GROUP BY d""",
    ),
    "nested_json": _q(
        DOCS,
        """
SELECT CAST(d AS VARCHAR) AS pmid, source AS owner, source AS journal,
       trim(text, chr(32) || chr(9) || chr(10) || chr(13)) AS title, lang AS first_language,
       source AS subset FROM docs""",
    ),
    "xml_round_trip": _q(
        IDS,
        """
SELECT CAST(pmid AS BIGINT) AS pmid, doi, journal_name, journal_volume, journal_year,
       journal_month FROM ids""",
    ),
    "xml_records_per_file": _q(
        IDS,
        """
SELECT 'pubmed' || substr(CAST(journal_year AS VARCHAR), 3, 2) || 'n'
         || lpad(CAST(pmid // 1000000 AS VARCHAR), 8, '0') || '.xml.gz' AS file_name,
       count(*) AS n_articles, count(*) FILTER (doi <> '') AS n_doi
FROM ids GROUP BY ALL""",
    ),
    "xml_deleted_log": _q(
        XML_CHANGES,
        "SELECT CAST(pmid AS BIGINT) AS pmid, file_name FROM changes WHERE op = 'D'",
    ),
    "files_listed": _q(XML_CHANGES, "SELECT file_name FROM files"),
    "store_statuses": _q(
        XML_CHANGES,
        """
SELECT file_name, CAST(CASE WHEN row_number() OVER (ORDER BY file_name)
         <= (SELECT count(*) FROM files) // 2 THEN 1 ELSE 2 END AS INTEGER) AS add_status
FROM files""",
    ),
    "stream_snapshot": _q(
        f"{CHANGES},{FILE_ORDER}",
        "SELECT pmid, op, file_name, seq, doi FROM winners WHERE op = 'U'",
    ),
}

STORE_SNAPSHOT = _q(
    f"{XML_CHANGES},{FILE_ORDER}",
    "SELECT CAST(pmid AS BIGINT) AS pmid, doi FROM winners WHERE op = 'U'",
)
ORACLE["xml_store_snapshot"] = STORE_SNAPSHOT
ORACLE["xml_stream_snapshot"] = STORE_SNAPSHOT

for _relation in ("author_rows", "abstract_rows"):
    ORACLE[f"xml_{_relation}"] = ORACLE[_relation]

# Tab separated files do not tell an empty text from a missing one.
ORACLE["tsv_round_trip"] = (
    "SELECT pmid, element_id, nullif(label, '') AS label, nullif(category, '') AS category,"
    f" nullif(text, '') AS text FROM ({ORACLE['abstract_rows']})"
)
ORACLE["affiliation_rows"] = _q(
    LINES,
    """
SELECT CAST(d AS BIGINT) AS pmid, i AS auth_order, CAST(k AS INTEGER) AS aff_order,
  CASE WHEN k = 0 THEN line ELSE 'second' END AS affiliation, CASE WHEN k = 0 THEN 'r' || i ELSE '' END AS ringgold_id,
  CASE WHEN k = 0 THEN 'i' || i ELSE '' END AS isni_id, CASE WHEN k = 0 THEN 'g' || i ELSE '' END AS grid_id
FROM lines, range(2) AS r(k) WHERE d % 13 <> 12 AND i % 3 <> 2""",
)


def _fingerprint(name: str, sql: str, columns: list[str]) -> str:
    values = ", '|', ".join(f"coalesce(nullif(CAST({c} AS VARCHAR), ''), '~')" for c in columns)
    return (
        f"SELECT '{name}' AS relation, count(*) AS n_rows, CAST(coalesce(sum(CAST('0x' || substr(md5(concat({values})), 1, 8) AS BIGINT)), 0)"
        f" AS BIGINT) AS fingerprint FROM ({sql})"
    )


def _file_columns(relation: str) -> list[str]:
    return sorted(c for c in schemas.columns(relation) if c not in schemas.TSV_DROPS.get(relation, ()))


ORACLE["tsv_main_round_trip"] = (
    "SELECT "
    + ", ".join(
        f"nullif({c}, '') AS {c}" if schemas.TABLES["main"][c].dataType.simpleString() == "string" else c
        for c in _file_columns("main")
    )
    + f" FROM ({ORACLE['main_rows']})"
)
_FILES = [
    _fingerprint(r, ORACLE["author_rows" if r == "authors" else f"{r}_rows"], _file_columns(r)) for r in schemas.RELATIONS
]
ORACLE["tsv_fan_out"] = " UNION ALL ".join(
    [
        *_FILES,
        _fingerprint(
            "deleted",
            "SELECT doc_id + 1 AS pmid, 'pubmed24n' || lpad(CAST(doc_id // 1000 AS VARCHAR), 8, '0') AS root FROM documents",
            ["pmid", "root"],
        ),
    ]
)
ORACLE["store_load_tsv"] = " UNION ALL ".join(
    [*_FILES, "SELECT 'rejects' AS relation, CAST(0 AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS fingerprint"]
)
ORACLE["bulk_first_wins"] = _q(
    CHANGES,
    """SELECT CAST(pmid AS BIGINT) AS pmid, doi, file_name
FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY file_name, seq) AS rn FROM changes) WHERE rn = 1""",
)
ORACLE["full_text_rows"] = """
SELECT CAST(doc_id AS BIGINT) AS pmid, lang || ' ' || text || doc_id AS title, source || lang AS coi,
  text || chr(945) || '<' AS text, CAST(NULL AS VARCHAR) AS leading_title, source AS leading_coi
FROM documents WHERE text IS NOT NULL"""
ORACLE["deep_reference_rows"] = _q(
    LINES,
    """SELECT CAST(d AS BIGINT) AS pmid, 'T' || i AS list_title, i AS list_index, CAST(0 AS INTEGER) AS ref_index,
  line || i AS citation FROM lines""",
)
ORACLE["stream_state_snapshot"] = ORACLE["stream_snapshot"]
ORACLE["stream_deletion_log"] = _q(
    XML_CHANGES, "SELECT DISTINCT CAST(pmid AS BIGINT) AS pmid, file_name FROM changes WHERE op = 'D'"
)
ORACLE["stream_article_rows"] = ORACLE["xml_round_trip"]
ORACLE["store_update"] = f"SELECT pmid, title, coi FROM ({ORACLE['full_text_rows']})"
ORACLE["store_compact"] = (
    "SELECT pmid, CAST(0 AS INTEGER) AS element_id, 'full' AS label, 'full' AS category, text"
    f" FROM ({ORACLE['full_text_rows']})"
)
ORACLE["store_documents"] = """
SELECT CAST(doc_id AS VARCHAR) AS pmid, source || lang AS coi, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lists
FROM documents WHERE text IS NOT NULL"""
ORACLE["store_reset"] = """
SELECT unnest(['updates', 'ids', 'main']) AS relation, CAST(0 AS BIGINT) AS n_rows
UNION ALL SELECT 'again', count(DISTINCT doc_id // 1000) FROM documents WHERE text IS NOT NULL"""
ORACLE["document_sink"] = " UNION ALL ".join(
    _fingerprint(name, ORACLE[name], sorted(columns.split(), key=lambda c: c.strip('"')))
    for name, columns in {
        "nested_citation": """pmid pmid_version owner status version_id version_date completed_month revised_day issn_type
            season medline_date journal_title country nlm_id issn_linking n_references coi subsets other_ids""",
        "nested_article": "pmid title pages locations dates copyright parts authors languages vernacular_title",
        "nested_terms": "pmid mesh keywords corrections chemicals supplements",
        "nested_lists": """pmid other_abstracts genes investigators notes missions banks grants pub_types names objects
            "references" """,
    }.items()
)
ORACLE["document_variant"] = ORACLE["nested_json"]


def _collated(form: str, key: str) -> str:
    return f"""SELECT l.pos, l.doi, min(i.pmid) AS pmid, CAST(CASE WHEN count(i.pmid) > 0 THEN 0 ELSE 2 END AS INTEGER) AS status,
  count(i.pmid) AS n_matches, '{form}' AS ignore
FROM lines l LEFT JOIN accented i ON i.doi <> '' AND {key.format("i.doi")} = {key.format("l.doi")} GROUP BY l.n, l.pos, l.doi"""


ORACLE["lookup_collated"] = _q(
    f"""{IDS},
marks AS (SELECT ['É', 'e', 'Ê', 'E' || chr(769)] AS m),
accented AS (SELECT pmid, CASE WHEN doi = '' THEN '' ELSE '10.1000/' || m[pmid // 2 % 4 + 1] || 'X' || (pmid // 2) END AS doi
             FROM ids, marks),
lines AS (SELECT row_number() OVER () AS n, l_partkey AS pos,
                 '10.1000/' || lower(m[l_linenumber % 4 + 1]) || 'x' || l_orderkey AS doi FROM lineitem, marks)""",
    _collated("case", "lower({})") + " UNION ALL " + _collated("accents", "strip_accents(lower({}))"),
)
