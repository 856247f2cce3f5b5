"""DuckDB SQL for the registered queries, written apart from the Spark code."""

from leadspark import config
from leadspark.fixtures import AS_OF, WIDE_TRUST


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(value) for value in values)


def _rows(rows) -> str:
    return ", ".join("(" + _list(row) + ")" for row in rows)


INVESTMENT = r"NULLIF(regexp_extract(summary, '\$[0-9]+M'), '')"

LEADS = (
    """
leads AS (
  SELECT o_orderkey AS lead_id, c_name AS companyName,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Technology' ELSE c_mktsegment END AS industry,
    r_name AS region,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'New Construction' WHEN '2-HIGH' THEN 'Expansion'
      WHEN '4-NOT SPECIFIED' THEN 'Downsizing' ELSE 'Merger' END AS opportunityType,
    c_name || CASE WHEN o_orderkey % 3 = 0 THEN ' plans an Expansion' ELSE ' signs a deal' END
      || CASE WHEN o_orderkey % 4 < 3 THEN ' worth $'
        || CAST(CAST(floor(o_totalprice / 100000) * 100 AS BIGINT) AS VARCHAR)
        || 'M in ' || r_name || ', doubling volumes' ELSE '' END AS summary,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Construction Services|Security' ELSE 'Security' END
      AS needs,
    CAST(o_orderkey % 10 + 1 AS BIGINT) AS score,
    c_name || ' said so' AS keyQuote,
    CASE o_orderkey % 5 WHEN 0 THEN 'reuters.com' WHEN 1 THEN 'bloomberg.com'
      WHEN 2 THEN 'my-sensational-blog.net' WHEN 3 THEN 'www.bloomberg.com'
      ELSE 'example.com' END AS host,
    o_orderkey % 13 AS corroborating
  FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), lead AS (
  SELECT *, 'https://' || host || '/story/' || lead_id AS sourceURL,
    """
    + INVESTMENT
    + """ AS investment FROM leads
)"""
)


def _reputation(trusted=config.TRUSTED_HOSTS) -> str:
    return (
        f"CASE WHEN host IN ({_list(trusted)}) THEN 100 "
        f"WHEN host IN ({_list(config.BLOCKED_HOSTS)}) THEN 0 ELSE 85 END"
    )


#: Name of a set of facts.
EVIDENCE_ID = (
    "substr(sha256(length(companyName) || ':' || companyName"
    " || length(region) || ':' || region || {fact}), 1, 32)"
)


def _corroboration(trusted=config.TRUSTED_HOSTS) -> str:
    """Every pair of leads with the same facts, as the definition has it."""
    return f"""
backed AS (
  SELECT a.lead_id, CAST(count(DISTINCT b.sourceURL) AS BIGINT) AS n_sources,
    array_to_string(list_sort(list(DISTINCT b.sourceURL)
      FILTER (WHERE b.sourceURL IS NOT NULL)), '|') AS urls
  FROM lead a LEFT JOIN lead b ON a.companyName = b.companyName AND a.region = b.region
    AND (a.investment IS NULL OR a.investment = b.investment)
    AND a.lead_id <> b.lead_id AND b.host IN ({_list(trusted)})
  GROUP BY a.lead_id
)"""


def _verified(sources: str, origin: str, trusted=config.TRUSTED_HOSTS) -> str:
    return f"""
verified AS (
  SELECT v.*, CAST(floor(reputation * 0.5 + n_given * 5 + 0.5) AS BIGINT) AS confidence
  FROM (SELECT lead.*, CAST({_reputation(trusted)} AS BIGINT) AS reputation,
      CAST({sources} AS BIGINT) AS n_given FROM {origin}) v
)"""


def _controlled(origin: str, tone: str = "'Passed'") -> str:
    construction, technology, summary = (
        _text(text)
        for text in (config.RULE_CONSTRUCTION, config.RULE_TECHNOLOGY, config.RULE_SUMMARY)
    )
    return f"""
controlled AS (
  SELECT c.*, greatest(0, 100 - 10 * n_failed - CASE consistency WHEN 'Failed' THEN 20 ELSE 0 END
    - CASE tone WHEN 'Failed' THEN 10 ELSE 0 END) AS quality
  FROM (
    SELECT r.*, CAST(CASE failed WHEN '' THEN 0 ELSE len(string_split(failed, '|')) END AS BIGINT)
      AS n_failed
    FROM (
      SELECT *, concat_ws('|',
          CASE WHEN opportunityType = 'New Construction' AND needs NOT LIKE '%Construction Services%'
            THEN {construction} END,
          CASE WHEN industry = 'Technology' AND score <= 7 THEN {technology} END,
          CASE WHEN length(summary) < 50 THEN {summary} END) AS failed,
        CASE WHEN lower(summary) LIKE '%expansion%' AND opportunityType = 'Downsizing'
          THEN 'Failed' ELSE 'Passed' END AS consistency,
        {tone} AS tone
      FROM {origin}) r) c
)"""


DECISION = """CASE WHEN confidence > 90 AND quality > 90 THEN 'Approved'
    WHEN confidence < 70 OR quality < 70 THEN 'Rejected' ELSE 'Manual Review' END"""

# Decided leads with the given number of sources.
SCORED = (
    LEADS
    + ","
    + _verified("corroborating", "lead")
    + ","
    + _controlled("verified")
    + f""",
scored AS (
  SELECT *, {DECISION} AS decision, '{AS_OF}' AS stamp,
    sha256('review|' || lead_id) AS id FROM controlled
), queue AS (SELECT * FROM scored WHERE decision = 'Manual Review')"""
)

ACTIONS = (
    SCORED
    + """,
actions AS (
  SELECT lead_id, attempt, keeps, status, corrected,
    CASE WHEN lead_id % 19 = 0 THEN NULL WHEN lead_id % 17 = 0 THEN 'unknown-' || lead_id
      ELSE id END AS id,
    CASE WHEN keeps THEN companyName END AS companyName,
    CASE WHEN keeps THEN region || CASE attempt WHEN 2 THEN ' NORTH' ELSE '' END END AS region,
    CASE WHEN keeps THEN CASE WHEN corrected THEN 'Acquisition' ELSE opportunityType END END
      AS opportunityType,
    CASE WHEN keeps THEN needs END AS needs,
    CASE WHEN NOT keeps THEN NULL WHEN lead_id % 6 = 0 THEN '7' WHEN lead_id % 15 = 0 THEN NULL
      ELSE CAST(score AS VARCHAR) END AS score,
    strftime(TIMESTAMP '2024-01-01' + to_seconds(CAST(lead_id * 7 + attempt * 60 AS BIGINT)),
      '%Y-%m-%dT%H:%M:%S') || '.000Z' AS submitted_at
  FROM (
    SELECT *, lead_id % 3 <> 1 AS keeps,
      CASE WHEN lead_id % 3 <> 1 THEN 'approved' ELSE 'declined' END AS status,
      lead_id % 3 <> 1 AND lead_id % 2 = 1 AS corrected
    FROM queue WHERE region <> 'AMERICA'
  ) JOIN (VALUES (CAST(1 AS BIGINT)), (2)) AS tries(attempt)
    ON attempt = 1 OR lead_id % 10 = 0
), waiting AS (
  SELECT * FROM queue WHERE id NOT IN (SELECT id FROM actions WHERE id IS NOT NULL)
)"""
)

MESSAGE_ERROR = """CASE lead_id % 11 WHEN 1 THEN 'not_base64' WHEN 2 THEN 'not_json'
    WHEN 3 THEN 'companyName:required' WHEN 4 THEN 'companyName:empty'
    WHEN 5 THEN 'opportunityScore:max' WHEN 7 THEN 'note:unknown' WHEN 8 THEN 'sourceURL:uri'
    WHEN 9 THEN 'potentialNeed:array' WHEN 10 THEN 'summary:string' END"""

ARTICLES = """
verdict AS (
  SELECT doc_id, CASE WHEN kind = 6 THEN 'record:object' WHEN kind = 1 THEN 'clean_text:required'
      WHEN kind = 2 OR text = '' THEN 'clean_text:empty' WHEN kind = 3 THEN 'source_url:uri'
      WHEN kind = 4 THEN 'source_domain:string' WHEN kind = 5 THEN 'language:unknown' END
      AS first_error,
    CAST(CASE WHEN kind IN (1, 2, 6) THEN 1 ELSE (CASE WHEN text = '' THEN 1 ELSE 0 END)
      + (CASE WHEN kind IN (3, 4, 5) THEN 1 ELSE 0 END) END AS BIGINT) AS n_errors
  FROM (SELECT *, doc_id % 7 AS kind FROM documents)
)"""


def _grid(name: str, kind: str) -> str:
    """A score of the enriched records: NULL when missing, 0 for a null."""
    return (
        f"CASE {kind} WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 69 WHEN 4 THEN 70 "
        f"WHEN 5 THEN 71 WHEN 6 THEN 90 WHEN 7 THEN 91 WHEN 8 THEN 100 END AS {name}"
    )


ENRICHED = (
    LEADS
    + f""",
enriched AS (
  SELECT lead_id, companyName, {_grid("confidence", "lead_id % 9")},
    {_grid("quality", "(lead_id // 9) % 9")},
    CASE WHEN lead_id % 23 = 7 THEN 'verification:object'
      WHEN lead_id % 29 = 8 THEN 'internal_qc:required' END AS first_error,
    CAST((CASE WHEN lead_id % 23 = 7 THEN 1 ELSE 0 END)
      + (CASE WHEN lead_id % 29 = 8 THEN 1 ELSE 0 END) AS BIGINT) AS n_errors
  FROM lead
)"""
)

REPLY_ERROR = """CASE WHEN lead_id % 7 = 0 OR lead_id % 11 = 0 OR lead_id % 13 = 0 THEN 'not_json'
    WHEN lead_id % 17 = 0 THEN 'no_text'
    WHEN lead_id % 19 = 0 THEN 'opportunityScore:integer' END"""


def _relevant(text: str) -> str:
    hits = (f"contains(lower({text}), {_text(word)})" for word in config.KEYWORDS)
    return "(" + " OR ".join(hits) + ")"


NOISE = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
    r"|<nav\b.*?</nav\s*>|<footer\b.*?</footer\s*>|<div class=\"ad\"[^>]*>.*?</div\s*>"
).replace("\\\"", '"')

CLEAN = rf"""
body AS (
  SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host,
    regexp_extract(regexp_replace(html, {_text(NOISE)}, ' ', 'g'),
      '(?is)<article[^>]*>(.*)</article>', 1) AS article
  FROM pages
), stripped AS (
  SELECT page_id, url, host, regexp_replace(regexp_replace(article, '(?i)</?b>', '', 'g'),
    '<[^>]*>', ' ', 'g') AS marked FROM body
), clean AS (
  SELECT page_id, url, host, trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(marked, '&lt;', '<'), '&gt;', '>'),
      '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'),
    '\s+', ' ', 'g')) AS clean_text FROM stripped
), fresh AS (
  SELECT * FROM clean WHERE url NOT LIKE 'http:%'
    AND {_relevant("clean_text")}
)"""

DOCUMENT_ARTICLES = rf"""
squashed AS (
  SELECT doc_id, source, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean_text FROM documents
), article AS (
  SELECT doc_id, clean_text, 'https://' || source || '.example.org/' || doc_id AS sourceURL
  FROM squashed WHERE {_relevant("clean_text")}
)"""

EXTRACTED = r"""
  CASE WHEN len(words) > 0 THEN words[1] ELSE 'Unknown' END AS companyName,
  CASE WHEN contains(lower(clean_text), 'tech') THEN 'Technology' ELSE 'General' END AS industry,
  CASE WHEN contains(lower(clean_text), 'expansion') THEN 'Expansion' ELSE 'Merger' END
    AS opportunityType,
  CAST(len(words) % 10 + 1 AS BIGINT) AS score, clean_text AS summary"""

WORDS = r"regexp_extract_all(clean_text, '[^\s.,]+') AS words"

PROMPT_HEAD, _, PROMPT_TAIL = config.PROMPT_TEMPLATE.partition(config.ARTICLE_MARKER)

MESSAGE_LEADS = f"""
received AS (
  SELECT * REPLACE (CASE WHEN lead_id % 11 = 6 THEN 9 ELSE score END AS score),
    {MESSAGE_ERROR} AS reason FROM lead
)"""


def _with(parts: str, select: str) -> str:
    return f"WITH {parts.strip()}\n{select.strip()}"


SCORES = "lead_id, confidence, CAST(quality AS BIGINT) AS quality"

CATALOG_WORDS = (
    "SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS keyword FROM benchmark"
)

ORACLES = {
    "source_catalog": f"""
SELECT source_url, source_type, count(*) AS n_pages
FROM pages JOIN (
  SELECT *, row_number() OVER () - 1 AS position
  FROM (VALUES {_rows(config.SOURCES)}) AS listed(source_url, source_type)
) ON page_id % {len(config.SOURCES)} = position
GROUP BY source_url, source_type""",
    "cycle_fanout": f"""
SELECT strftime(cycle, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS cycle_start, source_url, source_type
FROM (
  SELECT unnest(generate_series(date_trunc('day', first), last, INTERVAL 30 MINUTE)) AS cycle, first
  FROM (SELECT min(ts) AS first, max(ts) AS last FROM events)
) CROSS JOIN (VALUES {_rows(config.SOURCES)}) AS listed(source_url, source_type)
WHERE cycle > first - INTERVAL 30 MINUTE""",
    "envelope_decode": _with(
        LEADS,
        """
SELECT lead_id AS msg_id,
  CASE lead_id % 11 WHEN 1 THEN 'not_base64' WHEN 2 THEN 'not_json' END AS rejected,
  CASE WHEN lead_id % 11 IN (1, 2, 3) THEN NULL WHEN lead_id % 11 = 4 THEN ''
    ELSE companyName END AS company,
  CASE WHEN lead_id % 11 NOT IN (1, 2, 10) THEN summary END AS summary,
  CASE WHEN lead_id % 11 IN (1, 2) THEN NULL WHEN lead_id % 11 = 5 THEN '11'
    WHEN lead_id % 11 = 6 THEN '9' ELSE CAST(score AS VARCHAR) END AS score,
  CASE WHEN lead_id % 11 = 7 THEN 'extra' END AS note
FROM lead""",
    ),
    "envelope_roundtrip": _with(
        LEADS, "SELECT lead_id, companyName, summary, needs, score, sourceURL FROM lead"
    ),
    "keyword_catalog": f"""
SELECT keyword, count(doc_id) AS n_articles
FROM (VALUES {_rows((word,) for word in config.KEYWORDS)}) AS listed(keyword)
LEFT JOIN documents ON contains(lower(text), keyword) GROUP BY keyword""",
    "keyword_catalog_file": f"""
SELECT keyword, count(doc_id) AS n_articles FROM ({CATALOG_WORDS})
LEFT JOIN documents ON contains(lower(text), keyword) GROUP BY keyword""",
    "keyword_relevance_file": f"""
SELECT doc_id FROM documents WHERE EXISTS (
  SELECT 1 FROM ({CATALOG_WORDS}) WHERE length(keyword) > 9 AND contains(lower(text), keyword))""",
    "stage_table_stream": """
SELECT url AS article_url, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS source_domain
FROM pages""",
    "warehouse_rows": _with(
        SCORED,
        f"""
SELECT lead_id, decision, confidence, CAST(quality AS BIGINT) AS quality,
  '{AS_OF[:10]}' AS decision_date FROM scored WHERE decision <> 'Manual Review'""",
    ),
    "warehouse_typed": _with(
        SCORED,
        """
SELECT sourceURL, companyName, needs, score, reputation, 20 - n_failed AS rules_passed,
  failed AS failed_rules, decision, stamp AS decisionTimestamp FROM scored""",
    ),
    "review_queue": _with(
        SCORED,
        """
SELECT id, companyName, decision, confidence, CAST(quality AS BIGINT) AS quality FROM queue""",
    ),
    "review_queue_pending": _with(
        ACTIONS,
        """
SELECT CASE WHEN lead_id % 5 = 0 THEN 'doc-' || lead_id ELSE id END AS id, lead_id,
  companyName, sourceURL FROM waiting""",
    ),
    "corrections_log": _with(
        ACTIONS,
        """
SELECT id, attempt, status, corrected, region, submitted_at FROM actions WHERE id IS NOT NULL""",
    ),
    "alert_outbox": _with(
        SCORED,
        """
SELECT lead_id, '🔥 New Opportunity Hunted: ' || companyName AS line
FROM scored WHERE decision = 'Approved'""",
    ),
    "quarantine_counts": _with(
        LEADS + "," + ARTICLES,
        f"""
SELECT stage, reason, count(*) AS n_records FROM (
  SELECT 'external-verification' AS stage, {MESSAGE_ERROR} AS reason FROM lead
  UNION ALL SELECT 'article-to-analyze', first_error FROM verdict
) WHERE reason IS NOT NULL GROUP BY stage, reason""",
    ),
    "article_discovery": r"""
SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+') || link AS article_url,
  lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS source_domain
FROM (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="(/[^"]*)"', 1)) AS link FROM pages
)""",
    "url_resolution": r"""
WITH base AS (
  SELECT page_id, split_part(url, '://', 1) AS scheme, split_part(split_part(url, '://', 2), '/', 1) AS host,
    regexp_replace(url, '[?#].*$', '') AS plain FROM pages
), folders AS (
  SELECT *, scheme || '://' || host AS origin, regexp_replace(plain, '[^/]*$', '') AS folder FROM base
)
SELECT page_id, 'sibling' AS kind, folder || 's' || page_id AS article_url FROM folders
UNION ALL SELECT page_id, 'here', folder || 'h' || page_id FROM folders
UNION ALL SELECT page_id, 'parent', CASE WHEN folder = origin || '/' THEN folder
  ELSE regexp_replace(folder, '[^/]*/$', '') END || 'p' || page_id FROM folders
UNION ALL SELECT page_id, 'above the root', origin || '/r' || page_id FROM folders
UNION ALL SELECT page_id, 'dots within', origin || '/a/c' || page_id FROM folders
UNION ALL SELECT page_id, 'rooted', origin || '/t' || page_id FROM folders
UNION ALL SELECT page_id, 'query', plain || '?n=' || page_id || '&m=1' FROM folders
UNION ALL SELECT page_id, 'host', scheme || '://h' || page_id || '.example.org/y' FROM folders
UNION ALL SELECT page_id, 'whole', 'https://w' || page_id || '.example.org?q' FROM folders
UNION ALL SELECT page_id, kind, CAST(NULL AS VARCHAR) FROM folders,
  (VALUES ('fragment'), ('mail'), ('empty')) AS none(kind)""",
    "url_host": """
SELECT page_id, CASE WHEN page_id % 6 <> 3
  THEN lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) END AS host FROM pages""",
    "url_dedup": """
SELECT url AS article_url, min(page_id) AS page_id FROM pages
WHERE url NOT LIKE 'http:%' GROUP BY url""",
    "url_dedup_stream": """
SELECT DISTINCT 'https://news.example.org/' || user_id AS article_url FROM events""",
    "html_clean_text": _with(CLEAN, "SELECT page_id, clean_text FROM clean"),
    "keyword_relevance": f"""
SELECT doc_id, lang, source FROM documents WHERE {_relevant("text")}""",
    "relevant_articles": _with(
        CLEAN,
        "SELECT page_id, clean_text, url AS source_url, host AS source_domain FROM fresh",
    ),
    "validate_article": _with(
        ARTICLES, "SELECT doc_id, first_error IS NULL AS valid, first_error, n_errors FROM verdict"
    ),
    "validate_analysis": _with(
        LEADS,
        f"""
SELECT lead_id AS msg_id, first_error IS NULL AS valid, first_error,
  CAST(CASE WHEN first_error IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_errors
FROM (SELECT lead_id, {MESSAGE_ERROR} AS first_error FROM lead)""",
    ),
    "validate_enriched": _with(
        ENRICHED,
        "SELECT lead_id, first_error IS NULL AS valid, first_error, n_errors FROM enriched",
    ),
    "validate_correction": _with(
        LEADS,
        """
SELECT lead_id, lead_id % 7 IN (0, 6) AS valid,
  CASE WHEN lead_id % 7 NOT IN (0, 6) THEN 'id:required' END AS first_error,
  CAST(CASE WHEN lead_id % 7 NOT IN (0, 6) THEN 1 ELSE 0 END AS BIGINT) AS n_errors FROM lead""",
    ),
    "render_prompt": _with(
        DOCUMENT_ARTICLES,
        f"""
SELECT doc_id, {_text(PROMPT_HEAD)} || clean_text || {_text(PROMPT_TAIL)} AS prompt
FROM article""",
    ),
    "model_extract": _with(
        DOCUMENT_ARTICLES,
        f"""
SELECT doc_id, {EXTRACTED}, sourceURL FROM (SELECT *, {WORDS} FROM article)""",
    ),
    "reply_parse": _with(
        LEADS,
        f"""
SELECT lead_id, first_error, CASE WHEN first_error IS NULL THEN companyName END AS companyName,
  CASE WHEN first_error IS NULL THEN sourceURL END AS sourceURL
FROM (SELECT *, {REPLY_ERROR} AS first_error FROM lead)""",
    ),
    "source_reputation": _with(
        LEADS, f"SELECT lead_id, host, CAST({_reputation()} AS BIGINT) AS reputation FROM lead"
    ),
    "fact_extract": _with(LEADS, "SELECT lead_id, companyName, investment, region FROM lead"),
    "corroboration": _with(
        LEADS + "," + _corroboration(),
        f"""
SELECT lead_id, n_sources, coalesce(urls, '') AS urls,
  {EVIDENCE_ID.format(fact="coalesce(investment, '*')")} AS evidence_id
FROM backed JOIN lead USING (lead_id)""",
    ),
    "corroboration_urls": _with(
        LEADS,
        f"""
SELECT DISTINCT a.lead_id, b.sourceURL AS url FROM lead a JOIN lead b
  ON a.companyName = b.companyName AND a.region = b.region
  AND (a.investment IS NULL OR a.investment = b.investment) AND a.sourceURL <> b.sourceURL
WHERE a.lead_id % 2 = 0 AND b.host IN ({_list(config.TRUSTED_HOSTS)})""",
    ),
    "corroboration_evidence": _with(
        LEADS,
        f"""
SELECT DISTINCT {EVIDENCE_ID.format(fact="investmentFact")} AS evidence_id,
  companyName, region, investmentFact, sourceURL FROM (
  SELECT companyName, region, '*' AS investmentFact, sourceURL, host FROM lead
  UNION ALL SELECT companyName, region, investment, sourceURL, host FROM lead
  WHERE investment IS NOT NULL
) WHERE host IN ({_list(config.TRUSTED_HOSTS)})""",
    ),
    "confidence_score": _with(
        LEADS + "," + _verified("corroborating", "lead"),
        "SELECT lead_id, confidence FROM verified",
    ),
    "verification_enrich": _with(
        LEADS
        + ","
        + _corroboration()
        + ","
        + _verified("n_sources", "lead JOIN backed USING (lead_id)"),
        f"""
SELECT lead_id, companyName, confidence, reputation, n_given AS n_sources,
  coalesce(urls, '') AS urls, {EVIDENCE_ID.format(fact="coalesce(investment, '*')")} AS evidence_id,
  '{AS_OF}' AS lastCheckedTimestamp
FROM verified JOIN backed USING (lead_id)""",
    ),
    "business_rules": _with(
        LEADS + "," + _controlled("lead"), "SELECT lead_id, failed, n_failed FROM controlled"
    ),
    "logical_consistency": _with(
        LEADS + "," + _controlled("lead"), "SELECT lead_id, consistency FROM controlled"
    ),
    "tone_check": r"""
SELECT doc_id, CASE WHEN len([w for w in words
    if w IN ('doubling', 'volumes', 'deal', 'the', 'und', 'que')]) > len(words) * 0.125
  THEN 'Failed' ELSE 'Passed' END AS tone
FROM (SELECT doc_id, [w for w in string_split_regex(lower(text), '\W+') if w <> ''] AS words
  FROM documents)""",
    "quality_score": _with(
        LEADS
        + ","
        + _controlled("lead", "CASE WHEN lead_id % 7 = 0 THEN 'Failed' ELSE 'Passed' END"),
        "SELECT lead_id, CAST(quality AS BIGINT) AS quality FROM controlled",
    ),
    "qc_enrich": _with(
        LEADS
        + ","
        + _controlled("lead", "CASE WHEN lead_id % 7 = 0 THEN 'Failed' ELSE 'Passed' END"),
        f"""
SELECT lead_id, CAST(quality AS BIGINT) AS quality, 20 - n_failed AS rules_passed,
  n_failed AS rules_failed, failed, consistency AS logicalConsistency, tone AS toneAnalysis,
  '{AS_OF}' AS lastCheckedTimestamp FROM controlled""",
    ),
    "merge_branches": _with(
        SCORED,
        "SELECT lead_id, companyName, confidence, CAST(quality AS BIGINT) AS quality FROM scored",
    ),
    "merge_partials": _with(SCORED, f"SELECT {SCORES} FROM scored WHERE opportunityType <> 'Merger'"),
    "merge_partials_stream": _with(SCORED, f"SELECT {SCORES} FROM scored"),
    "merge_quarantine_stream": """
WITH halves AS (SELECT o_orderkey AS lead_id, o_orderkey % 7 <> 0 AS v, o_orderkey % 5 <> 0 AS c,
  abs(CASE WHEN o_orderkey % 13 = 0 THEN 3600 ELSE 0 END + o_orderkey % 301
    - CASE WHEN o_orderkey % 11 = 0 THEN 3600 ELSE 0 END) <= 600 AS near FROM orders)
SELECT lead_id, 'both' AS half, 'merged' AS reason FROM halves WHERE v AND c AND near
UNION ALL SELECT lead_id, 'verification', 'other half missing or late' FROM halves
  WHERE v AND NOT (c AND near)
UNION ALL SELECT lead_id, 'internal_qc', 'other half missing or late' FROM halves
  WHERE c AND NOT (v AND near)""",
    "decision_matrix": _with(
        ENRICHED,
        f"SELECT lead_id, {DECISION} AS decision FROM enriched WHERE first_error IS NULL",
    ),
    "decision_stamp": _with(
        SCORED, f"SELECT {SCORES}, decision, stamp AS decisionTimestamp FROM scored"
    ),
    "route_counts": _with(
        SCORED,
        """
SELECT destination, decision, count(*) AS n_leads FROM scored JOIN (VALUES
  ('review', 'Manual Review'), ('final-analysis', 'Approved'), ('final-analysis', 'Rejected'),
  ('final-leads', 'Approved')) AS places(destination, decision) USING (decision)
GROUP BY destination, decision""",
    ),
    "record_outcome": _with(
        ENRICHED,
        f"""
SELECT lead_id, CAST(CASE WHEN first_error IS NULL THEN 200 ELSE 400 END AS BIGINT) AS code,
  CASE WHEN first_error IS NOT NULL THEN 'Invalid enriched analysis format: ' || first_error
    WHEN decision = 'Manual Review' THEN 'Analysis for ' || companyName || ' requires manual review.'
    ELSE 'Published final analysis for ' || companyName || ' with decision: ' || decision END
    AS message
FROM (SELECT *, {DECISION} AS decision FROM enriched)""",
    ),
    "review_log_event": _with(
        SCORED,
        "SELECT lead_id, 'true' AS review_required, companyName AS company, summary FROM queue",
    ),
    "review_alert_window": """
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS window_start,
  count(*) AS n_events FROM events WHERE event_type = 'error' GROUP BY 1""",
    "review_alert_stream": """
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S') || '.000Z' AS window_start,
  count(*) AS n_events FROM events WHERE event_type = 'error' GROUP BY 1""",
    "review_form_view": _with(
        SCORED,
        """
SELECT id, CASE WHEN lead_id % 5 = 0 THEN 'No Company Name' ELSE companyName END AS title,
  CASE WHEN lead_id % 5 = 0 THEN '' ELSE companyName END AS companyName, industry, region,
  opportunityType, summary,
  CASE WHEN lead_id % 9 = 0 THEN '' ELSE replace(needs, '|', chr(10)) END AS potentialNeed,
  CASE WHEN lead_id % 11 = 0 THEN 0 ELSE score END AS score,
  CASE WHEN lead_id % 7 = 0 THEN '' ELSE keyQuote END AS keyQuote FROM queue""",
    ),
    "review_action": _with(
        ACTIONS,
        """
SELECT lead_id, attempt, id, status, corrected, companyName, opportunityType, needs, score
FROM actions""",
    ),
    "review_queue_resolve": _with(ACTIONS, "SELECT id, lead_id FROM waiting"),
    "tuning_dataset": _with(
        ACTIONS,
        """
SELECT q.id, a.status, CAST(CASE a.status WHEN 'approved' THEN 1 ELSE 0 END AS BIGINT) AS label,
  q.region AS original_region, a.region AS answer_region,
  CASE WHEN NOT keeps THEN '' ELSE concat_ws('|',
    CASE WHEN a.region <> q.region THEN 'region' END,
    CASE WHEN a.opportunityType <> q.opportunityType THEN 'opportunityType' END,
    CASE WHEN CAST(q.score AS VARCHAR) IS DISTINCT FROM a.score THEN 'opportunityScore' END)
  END AS changed
FROM queue q JOIN actions a USING (id)
WHERE a.attempt = CASE WHEN q.lead_id % 10 = 0 THEN 2 ELSE 1 END""",
    ),
    "review_queue_count": _with(
        ACTIONS, "SELECT count(*) AS n_items, count(*) = 0 AS is_empty FROM waiting"
    ),
    "alert_payload": _with(
        SCORED,
        """
SELECT lead_id, '🔥 New Opportunity Hunted: ' || companyName AS line,
  '🚀 ' || companyName AS header, '*Industry:*' || chr(10) || industry AS industry,
  '*Region:*' || chr(10) || region AS region, '*Opportunity:* ' || summary AS opportunity,
  '*Potential Needs:*' || chr(10) || '• ' || replace(needs, '|', chr(10) || '• ') AS needs,
  'Source: <' || sourceURL || '|Click to view>' AS source,
  ' | Confidence: *' || confidence || '%*' AS confidence
FROM scored WHERE decision = 'Approved'""",
    ),
    "lead_report": _with(
        SCORED,
        """
SELECT companyName, summary, sourceURL, score AS opportunityScore
FROM scored WHERE decision = 'Approved'""",
    ),
    "region_score_map": _with(
        SCORED,
        """
SELECT region, count(*) AS n_leads, CAST(sum(score) AS BIGINT) AS sum_score,
  avg(score) AS avg_score FROM scored WHERE decision = 'Approved' GROUP BY region""",
    ),
    "lead_scoring": _with(
        LEADS
        + ","
        + _corroboration()
        + ","
        + _verified("n_sources", "lead JOIN backed USING (lead_id)")
        + ","
        + _controlled("verified"),
        f"SELECT {SCORES}, n_given AS n_sources, {DECISION} AS decision FROM controlled",
    ),
    "lead_scoring_given": _with(SCORED, f"SELECT {SCORES}, decision FROM scored"),
    "lead_scoring_stream": _with(
        LEADS
        + ","
        + _corroboration(WIDE_TRUST)
        + ","
        + MESSAGE_LEADS
        + ","
        + _verified("n_sources", "received AS lead JOIN backed USING (lead_id)", WIDE_TRUST)
        + ","
        + _controlled("verified")
        + f""",
decided AS (SELECT *, {DECISION} AS decision FROM controlled)""",
        """
SELECT lead_id AS msg_id, 'quarantine' AS destination, CAST(NULL AS VARCHAR) AS decision, reason
FROM decided WHERE reason IS NOT NULL
UNION ALL
SELECT lead_id, destination, decision, NULL FROM decided JOIN (VALUES
  ('review', 'Manual Review'), ('final-analysis', 'Approved'), ('final-analysis', 'Rejected'),
  ('final-leads', 'Approved')) AS places(destination, decision) USING (decision)
WHERE reason IS NULL""",
    ),
    "article_leads": _with(
        CLEAN
        + f""",
extracted AS (
  SELECT page_id, url AS sourceURL, {EXTRACTED}, 'Security' AS needs, 43 AS confidence
  FROM (SELECT *, {WORDS} FROM fresh)
),"""
        + _controlled("extracted"),
        f"""
SELECT page_id, companyName, sourceURL, CAST(confidence AS BIGINT) AS confidence,
  CAST(quality AS BIGINT) AS quality, {DECISION} AS decision FROM controlled""",
    ),
}
