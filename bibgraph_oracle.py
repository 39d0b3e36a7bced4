"""DuckDB oracle SQL for every registered query.

Each statement starts from the driver's pre-registered views (part, lineitem,
...) and re-derives the graph with the same definitions as
``bibgraph.sources.fixtures`` — written independently as SQL, so a bug on one
side does not hide on the other.  Doubles are rounded to 6 places on both
sides; integer outputs are BIGINT.
"""

from __future__ import annotations

from bibgraph.operators.nouns import seed_tokens

GRAPH_VIEWS = """
paper AS (
  SELECT p.p_partkey AS paperId, nullif(p.p_name, 'blue anvil') AS title,
         CAST(2017 + p.p_size % 8 AS BIGINT) AS year, CAST(p.p_size AS BIGINT) AS citationCount
  FROM part p),
published_in AS (
  SELECT paperId, kind,
         CASE kind WHEN 'Journal' THEN 'J-' WHEN 'Workshop' THEN 'W-' ELSE 'C-' END || p_brand AS name,
         year, CASE WHEN kind <> 'Journal' THEN CAST(p_size % 20 AS BIGINT) END AS edition
  FROM (SELECT p_partkey AS paperId, p_brand, p_size,
               CAST(2017 + p_size % 8 AS BIGINT) AS year,
               CASE WHEN p_type IN ('LARGE', 'SMALL') THEN 'Journal'
                    WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'Workshop'
                    WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 'Conference' END AS kind
        FROM part) x
  WHERE kind IS NOT NULL),
author AS (
  SELECT c.c_custkey AS authorId, c.c_name AS name, n.n_name AS affiliation,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'university' ELSE 'company' END AS affiliationType
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
wrote AS (
  SELECT DISTINCT o.o_custkey AS authorId, l.l_partkey AS paperId
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
line AS (
  SELECT l_orderkey, l_linenumber, l_partkey AS part, l_suppkey AS supp,
         row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_no,
         lag(l_partkey) OVER w AS prev_part, lead(l_partkey) OVER w AS next_part
  FROM lineitem
  WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)),
cites AS (
  SELECT DISTINCT part AS src, prev_part AS dst FROM line WHERE part <> prev_part),
contains AS (
  SELECT DISTINCT paperId, keyword FROM (
    SELECT p_partkey AS paperId, unnest(string_split(p_name, ' ')) AS keyword FROM part) w
  WHERE keyword <> ''),
keyword AS (SELECT DISTINCT keyword AS text FROM contains),
n_cited AS (SELECT dst AS paperId, count(*) AS n_cited FROM cites GROUP BY dst)
"""

COMMUNITY_TERMS_SQL = "('anvil', 'bolt', 'gear', 'gizmo', 'plate', 'ring', 'rod')"


def with_graph(body: str, extra: str = "") -> str:
    """Prefix ``body`` with the graph views (plus optional extra CTEs)."""
    ctes = GRAPH_VIEWS.strip()
    if extra.strip():
        ctes += ",\n" + extra.strip()
    return f"WITH {ctes}\n{body}"


COMMUNITY_CTES = f"""
comm_paper AS (SELECT DISTINCT paperId FROM contains WHERE keyword IN {COMMUNITY_TERMS_SQL}),
venue_share AS (
  SELECT v.kind, v.name,
         count(*) FILTER (WHERE c.paperId IS NOT NULL) AS num_comm_papers,
         count(*) AS num_papers
  FROM (SELECT DISTINCT kind, name, paperId FROM published_in
        WHERE kind IN ('Journal', 'Conference')) v
  LEFT JOIN comm_paper c ON c.paperId = v.paperId
  GROUP BY v.kind, v.name),
comm_venue AS (
  SELECT kind, name, num_comm_papers, num_papers,
         CAST(num_comm_papers AS DOUBLE) / num_papers AS share
  FROM venue_share WHERE num_comm_papers > 0
   AND CAST(num_comm_papers AS DOUBLE) / num_papers >= 0.9),
cv_paper AS (
  SELECT DISTINCT p.paperId FROM published_in p
  JOIN comm_venue v ON p.kind = v.kind AND p.name = v.name),
top_paper AS (
  SELECT dst AS paperId, count(*) AS n_citations FROM cites
  WHERE src IN (SELECT paperId FROM cv_paper) AND dst IN (SELECT paperId FROM cv_paper)
  GROUP BY dst ORDER BY n_citations DESC, paperId LIMIT 100)
"""

ANALYTICS = {
    "top3_cited_per_conference": with_graph("""
SELECT conference, t1 AS topCitedPaper1, t2 AS topCitedPaper2, t3 AS topCitedPaper3
FROM (
  SELECT r.name AS conference, count(*) AS n,
         max(CASE WHEN rk = 1 THEN p.title END) AS t1,
         max(CASE WHEN rk = 2 THEN p.title END) AS t2,
         max(CASE WHEN rk = 3 THEN p.title END) AS t3
  FROM (SELECT pub.name, c.paperId,
               row_number() OVER (PARTITION BY pub.name ORDER BY c.n_cited DESC, c.paperId) AS rk
        FROM n_cited c JOIN published_in pub ON pub.paperId = c.paperId
        WHERE pub.kind = 'Conference') r
  LEFT JOIN paper p ON p.paperId = r.paperId
  WHERE rk <= 3
  GROUP BY r.name) g
WHERE n = 3 AND NOT (t1 = 'None' OR t2 = 'None' OR t3 = 'None')
"""),
    "conference_communities": with_graph("""
SELECT m.conferenceName, m.authorId, a.name, m.distinctEditions
FROM (SELECT pub.name AS conferenceName, w.authorId,
             count(DISTINCT pub.edition) AS distinctEditions
      FROM wrote w JOIN published_in pub ON pub.paperId = w.paperId
      WHERE pub.kind = 'Conference'
      GROUP BY 1, 2 HAVING count(DISTINCT pub.edition) >= 4) m
JOIN author a ON a.authorId = m.authorId
"""),
    "conference_community_sizes": with_graph("""
SELECT conferenceName, count(*) AS community_size
FROM (SELECT pub.name AS conferenceName, w.authorId
      FROM wrote w JOIN published_in pub ON pub.paperId = w.paperId
      WHERE pub.kind = 'Conference'
      GROUP BY 1, 2 HAVING count(DISTINCT pub.edition) >= 4) m
WHERE authorId IN (SELECT authorId FROM author)
GROUP BY conferenceName
"""),
    "journal_impact_factor": with_graph("""
SELECT r.journalName, CAST(sum(c.c) AS BIGINT) AS num_citations, n.num_papers,
       round(CAST(sum(c.c) AS DOUBLE) / n.num_papers, 6) AS impact_factor,
       CAST(sum(c.c) AS BIGINT) // n.num_papers AS impact_factor_int
FROM (SELECT name AS journalName, paperId FROM published_in
      WHERE kind = 'Journal' AND year IN (2022, 2021)) r
JOIN (SELECT ci.dst AS paperId, sum(m.m) AS c
      FROM cites ci
      JOIN (SELECT paperId, count(*) AS m FROM published_in
            WHERE kind = 'Journal' AND year = 2023 GROUP BY paperId) m ON m.paperId = ci.src
      GROUP BY ci.dst) c ON c.paperId = r.paperId
JOIN (SELECT name AS journalName, count(*) AS num_papers FROM published_in
      WHERE kind = 'Journal' AND year IN (2022, 2021) GROUP BY name) n
  ON n.journalName = r.journalName
GROUP BY r.journalName, n.num_papers
"""),
    "author_h_index": with_graph("""
SELECT h.authorId, a.name, h.h_index
FROM (SELECT authorId, CAST(max(rk) AS BIGINT) AS h_index
      FROM (SELECT w.authorId, c.n_cited,
                   row_number() OVER (PARTITION BY w.authorId ORDER BY c.n_cited DESC) AS rk
            FROM wrote w JOIN n_cited c ON c.paperId = w.paperId) s
      WHERE n_cited >= rk
      GROUP BY authorId) h
LEFT JOIN author a ON a.authorId = h.authorId
"""),
}

RECOMMEND = {
    "community_keywords": with_graph(f"""
SELECT text AS keyword, 'database' AS community FROM keyword
WHERE text IN {COMMUNITY_TERMS_SQL}
"""),
    "community_venues": with_graph("""
SELECT kind, name, num_comm_papers, num_papers, round(share, 6) AS share,
       'database' AS community
FROM comm_venue
""", COMMUNITY_CTES),
    "top_community_papers": with_graph("SELECT paperId, n_citations FROM top_paper",
                                       COMMUNITY_CTES),
    "potential_reviewers": with_graph("""
SELECT DISTINCT authorId, 'database' AS community FROM wrote
WHERE paperId IN (SELECT paperId FROM top_paper)
""", COMMUNITY_CTES),
    "gurus": with_graph("""
SELECT authorId, count(*) AS n_top_papers, 'database' AS community FROM wrote
WHERE paperId IN (SELECT paperId FROM top_paper)
GROUP BY authorId HAVING count(*) >= 2
""", COMMUNITY_CTES),
}


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(ANALYTICS)
    out.update(RECOMMEND)
    return out


def _pagerank_cites_sql(iterations: int = 20, d: float = 0.85, which: str = "true") -> str:
    """PageRank on CITES unrolled into one CTE per round."""
    base = 1.0 - d
    ctes = [
        "v AS (SELECT paperId AS id FROM paper)",
        f"e AS (SELECT DISTINCT src, dst FROM cites WHERE {which})",
        "outdeg AS (SELECT src, count(*) AS k FROM e GROUP BY src)",
        f"r0 AS (SELECT id, CAST({base} AS DOUBLE) AS rank FROM v)",
    ]
    for i in range(1, iterations + 1):
        ctes.append(f"""r{i} AS (
  SELECT v.id, {base} + {d} * coalesce(s.inc, 0.0) AS rank FROM v LEFT JOIN (
    SELECT e.dst, sum(r.rank / o.k) AS inc FROM e
    JOIN r{i - 1} r ON r.id = e.src JOIN outdeg o ON o.src = e.src
    GROUP BY e.dst) s ON s.dst = v.id)""")
    return with_graph(f"SELECT id AS paperId, round(rank, 6) AS score FROM r{iterations}",
                      ",\n".join(ctes))


_PR_WROTE_CTES = """
aut_out AS (SELECT authorId, count(*) AS k FROM wrote GROUP BY authorId),
pr AS (
  SELECT 'Paper' AS label, p.paperId AS key,
         round(0.15 + 0.85 * coalesce(s.inc, 0.0), 6) AS score
  FROM paper p LEFT JOIN (
    SELECT w.paperId, sum(0.15 / o.k) AS inc FROM wrote w
    JOIN aut_out o ON o.authorId = w.authorId GROUP BY w.paperId) s ON s.paperId = p.paperId
  UNION ALL
  SELECT 'Author' AS label, authorId AS key, 0.15 AS score FROM author)
"""

ALGORITHMS = {
    "project_counts": with_graph("""
SELECT (SELECT count(*) FROM paper) + (SELECT count(*) FROM author) AS nodeCount,
       (SELECT count(*) FROM wrote) AS relationshipCount
"""),
    # WROTE runs Author -> Paper only: the loop is exact after two rounds.
    "pagerank_wrote": with_graph("SELECT label, key, score FROM pr", _PR_WROTE_CTES),
    "pagerank_top10": with_graph("""
SELECT CASE WHEN label = 'Paper' THEN key END AS paperId, score FROM pr
ORDER BY score DESC, label, key LIMIT 10
""", _PR_WROTE_CTES),
    "pagerank_cites": _pagerank_cites_sql(),
    # WROTE is bipartite and acyclic: every vertex is its own component.
    "scc_wrote": with_graph("""
SELECT 'Paper' AS label, paperId AS key, 'Paper' AS componentLabel, paperId AS componentKey
FROM paper
UNION ALL
SELECT 'Author', authorId, 'Author', authorId FROM author
"""),
}


def oracle_sql() -> dict[str, str]:  # noqa: F811
    out: dict[str, str] = {}
    out.update(ANALYTICS)
    out.update(RECOMMEND)
    out.update(ALGORITHMS)
    return out


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


# SCC oracle: mutual reachability from the transitive closure of CITES;
# the component id is the smallest paperId of the component.
_SCC_CTES = """
reach(src, dst) AS (
  SELECT src, dst FROM cites
  UNION
  SELECT r.src, c.dst FROM reach r JOIN cites c ON c.src = r.dst),
scc AS (
  SELECT p.paperId, coalesce(min(m.src), p.paperId) AS componentId
  FROM paper p LEFT JOIN (
    SELECT r.src, r.dst FROM reach r JOIN reach b ON b.src = r.dst AND b.dst = r.src) m
    ON m.dst = p.paperId
  GROUP BY p.paperId)
"""

ALGORITHMS["scc_cites"] = _recursive(with_graph("SELECT paperId, componentId FROM scc", _SCC_CTES))
ALGORITHMS["scc_top10"] = _recursive(with_graph(
    "SELECT paperId, componentId FROM scc ORDER BY componentId DESC, paperId LIMIT 10",
    _SCC_CTES))


# --- graph load from reference-shaped load files ---------------------------

LOAD_CTES = """
city AS (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS city_no, count(*) OVER () AS n_cities
         FROM nation),
load_rows AS (
  SELECT kind, l.row_no,
         CAST(l.part AS VARCHAR) AS paperId,
         nullif(p.p_name, 'blue anvil') AS title,
         'p/' || CAST(l.part AS VARCHAR) || '/' || CAST(l.l_orderkey AS VARCHAR) AS url,
         d.text AS abstract,
         CAST(2017 + p.p_size % 8 AS VARCHAR) AS year,
         CAST(p.p_size AS VARCHAR) AS citationCount,
         CAST(o.o_custkey AS VARCHAR) || ', ' || CAST(l.supp AS VARCHAR) AS authorIds,
         CAST(o.o_custkey AS VARCHAR) AS corresponding_author,
         n.n_name AS venue, 'Y' AS approved,
         CAST(l.supp + 1 AS VARCHAR) || ', ' || CAST(o.o_custkey + 1 AS VARCHAR) AS reviewers,
         'review ' || CAST(l.l_orderkey AS VARCHAR) || ';review ' || CAST(l.l_linenumber AS VARCHAR) AS comments,
         CASE WHEN kind <> 'Journal' THEN prefix || p.p_brand END AS proceedings,
         CASE WHEN kind <> 'Journal' THEN CAST(p.p_size % 20 AS VARCHAR) END AS edition,
         CASE WHEN kind = 'Journal' THEN prefix || p.p_brand END AS journal_name,
         CASE WHEN kind = 'Journal' THEN CAST(p.p_size AS VARCHAR) END AS journal_volume,
         replace(p.p_name, ' ', ',') || ',' ||
           lower(['Big Data', 'Indexing', 'NLP', 'Data Management'][CAST(l.part % 4 AS INTEGER) + 1]) AS keywords,
         concat_ws(', ', CAST(l.prev_part AS VARCHAR), CAST(l.next_part AS VARCHAR),
                   CASE WHEN l.l_linenumber = 1 THEN 'ext-' || CAST(l.supp AS VARCHAR) END) AS Citations
  FROM line l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN (SELECT *, CASE WHEN p_type IN ('LARGE', 'SMALL') THEN 'Journal'
                       WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'Workshop'
                       WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 'Conference' END AS kind,
                  CASE WHEN p_type IN ('LARGE', 'SMALL') THEN 'J-'
                       WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'W-' ELSE 'C-' END AS prefix
        FROM part) p ON p.p_partkey = l.part
  LEFT JOIN documents d ON d.doc_id = l.part
  LEFT JOIN city n ON n.city_no = (l.part + l.l_orderkey) % n.n_cities
  WHERE kind IS NOT NULL),
author_rows AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS authorId, c.c_name AS name, n.n_name AS Affiliations,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'university' ELSE 'company' END AS Affiliation_type,
         c.c_custkey AS row_no
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
  UNION ALL
  SELECT CAST(s.s_suppkey AS VARCHAR), s.s_name, n.n_name, 'company',
         1099511627776 + s.s_suppkey
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey),
l_paper AS (
  SELECT paperId, title, url, abstract,
         CAST(trunc(TRY_CAST(year AS DOUBLE)) AS BIGINT) AS year,
         CAST(trunc(TRY_CAST(citationCount AS DOUBLE)) AS BIGINT) AS citationCount
  FROM (SELECT *, row_number() OVER (
          PARTITION BY paperId
          ORDER BY CASE kind WHEN 'Conference' THEN 1 WHEN 'Journal' THEN 2 ELSE 3 END, row_no) AS rn
        FROM load_rows) x
  WHERE rn = 1),
l_author AS (
  SELECT authorId, name, Affiliations AS affiliation, Affiliation_type AS affiliationType
  FROM (SELECT *, row_number() OVER (PARTITION BY authorId ORDER BY row_no) AS rn
        FROM author_rows) x WHERE rn = 1),
l_wrote_rows AS (
  SELECT r.paperId, trim(a.raw) AS authorId,
         coalesce(r.corresponding_author = trim(a.raw), false) AS corresponding,
         CASE r.kind WHEN 'Journal' THEN 1 WHEN 'Workshop' THEN 2 ELSE 3 END AS file_no, r.row_no
  FROM load_rows r, unnest(string_split(r.authorIds, ',')) AS a(raw)),
l_wrote AS (
  SELECT authorId, paperId, corresponding FROM (
    SELECT *, row_number() OVER (PARTITION BY authorId, paperId ORDER BY file_no DESC, row_no DESC) AS rn
    FROM l_wrote_rows
    WHERE paperId IN (SELECT paperId FROM l_paper) AND authorId IN (SELECT authorId FROM l_author)) x
  WHERE rn = 1),
l_venue_rows AS (
  SELECT *, CASE WHEN kind = 'Journal' THEN journal_name ELSE proceedings END AS name
  FROM load_rows
  WHERE (CASE WHEN kind = 'Journal' THEN journal_name ELSE proceedings END) IS NOT NULL
    AND (CASE WHEN kind = 'Journal' THEN journal_name ELSE proceedings END) <> ''),
l_published_in AS (
  SELECT paperId, kind, name,
         CAST(trunc(TRY_CAST(year AS DOUBLE)) AS BIGINT) AS year,
         CAST(trunc(TRY_CAST(edition AS DOUBLE)) AS BIGINT) AS edition,
         venue, CASE WHEN kind = 'Journal' THEN journal_volume END AS journal_volume
  FROM (SELECT *, row_number() OVER (PARTITION BY paperId, kind, name ORDER BY row_no DESC) AS rn
        FROM l_venue_rows WHERE paperId IN (SELECT paperId FROM l_paper)) x
  WHERE rn = 1),
l_cites AS (
  SELECT DISTINCT r.paperId AS src, trim(c.item) AS dst
  FROM load_rows r, unnest(string_split(r.Citations, ',')) AS c(item)
  WHERE r.Citations IS NOT NULL AND r.Citations <> ''
    AND r.paperId IN (SELECT paperId FROM l_paper)),
l_contains AS (
  SELECT DISTINCT r.paperId, trim(k.item) AS keyword
  FROM load_rows r, unnest(string_split(r.keywords, ',')) AS k(item)
  WHERE r.paperId IN (SELECT paperId FROM l_paper)
    AND trim(k.item) IS NOT NULL AND trim(k.item) <> ''),
l_review_rows AS (
  SELECT r.paperId, trim(v.item) AS authorId, v.item AS raw_id, r.approved, r.comments,
         CASE r.kind WHEN 'Conference' THEN 1 WHEN 'Journal' THEN 2 ELSE 3 END AS file_no, r.row_no
  FROM load_rows r, unnest(string_split(r.reviewers, ',')) AS v(item)
  WHERE r.paperId IN (SELECT paperId FROM l_paper))
"""

BUILD = {
    "paper_nodes": with_graph("""
SELECT paperId, title, url, abstract, year, citationCount FROM l_paper
""", LOAD_CTES),
    "merge_nodes_first_wins": with_graph("SELECT * FROM l_author", LOAD_CTES),
    "wrote_edges": with_graph("SELECT * FROM l_wrote", LOAD_CTES),
    "published_in_edges": with_graph("SELECT * FROM l_published_in", LOAD_CTES),
    "merge_edges_last_wins": with_graph(
        "SELECT paperId, kind, name, venue FROM l_published_in", LOAD_CTES),
    "venue_nodes": with_graph("SELECT DISTINCT kind, name FROM l_venue_rows", LOAD_CTES),
    "cites_edges_with_stubs": with_graph("""
SELECT src, dst, dst NOT IN (SELECT paperId FROM l_paper) AS dst_is_stub FROM l_cites
""", LOAD_CTES),
    "keyword_nodes": with_graph("""
SELECT DISTINCT k.item AS text FROM load_rows r, unnest(string_split(r.keywords, ',')) AS k(item)
""", LOAD_CTES),
    "contains_edges": with_graph("SELECT * FROM l_contains", LOAD_CTES),
    "reviewed_edges": with_graph("""
SELECT DISTINCT authorId, paperId FROM l_review_rows
WHERE authorId IN (SELECT authorId FROM l_author)
""", LOAD_CTES),
    "reviewed_edges_untrimmed": with_graph("""
SELECT DISTINCT raw_id AS authorId, paperId FROM l_review_rows
WHERE raw_id IN (SELECT authorId FROM l_author)
""", LOAD_CTES),
    "reviewed_edges_evolved": with_graph("""
SELECT authorId, paperId, approved, comments FROM (
  SELECT *, row_number() OVER (PARTITION BY authorId, paperId ORDER BY file_no DESC, row_no DESC) AS rn
  FROM l_review_rows WHERE authorId IN (SELECT authorId FROM l_author)) x
WHERE rn = 1
""", LOAD_CTES),
    "affiliated_edges": with_graph("""
SELECT DISTINCT authorId, Affiliations AS organization FROM author_rows
WHERE Affiliations IS NOT NULL
""", LOAD_CTES),
    "graph_counts": with_graph("""
SELECT 'paper' AS "table", (SELECT count(*) FROM l_paper)
       + (SELECT count(DISTINCT dst) FROM l_cites WHERE dst NOT IN (SELECT paperId FROM l_paper)) AS "rows"
UNION ALL SELECT 'author', (SELECT count(*) FROM l_author)
UNION ALL SELECT 'venue', (SELECT count(*) FROM (SELECT DISTINCT kind, name FROM l_venue_rows))
UNION ALL SELECT 'keyword', (SELECT count(DISTINCT keyword) FROM l_contains)
UNION ALL SELECT 'organization', (SELECT count(DISTINCT Affiliations) FROM author_rows WHERE Affiliations IS NOT NULL)
UNION ALL SELECT 'wrote', (SELECT count(*) FROM l_wrote)
UNION ALL SELECT 'published_in', (SELECT count(*) FROM l_published_in)
UNION ALL SELECT 'cites', (SELECT count(*) FROM l_cites)
UNION ALL SELECT 'contains', (SELECT count(*) FROM l_contains)
UNION ALL SELECT 'reviewed', (SELECT count(*) FROM (SELECT DISTINCT authorId, paperId FROM l_review_rows
                                WHERE authorId IN (SELECT authorId FROM l_author)))
UNION ALL SELECT 'affiliated_to', (SELECT count(*) FROM (SELECT DISTINCT authorId, Affiliations FROM author_rows
                                WHERE Affiliations IS NOT NULL))
""", LOAD_CTES),
}
ALGORITHMS.update(BUILD)


# --- cleaning / ETL ----------------------------------------------------------

RAW_CTES = """
raw_papers AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS paperId,
         [' Big Data', 'Big Data', 'Indexing', 'NLP'][CAST(p.p_partkey % 4 AS INTEGER) + 1] AS field_query,
         p.p_name AS title, 'p/' || CAST(p.p_partkey AS VARCHAR) AS url,
         CASE WHEN p.p_type = 'PROMO' THEN 'Workshop on ' || p.p_brand
              WHEN p.p_type = 'ECONOMY' THEN NULL
              WHEN p.p_size % 4 = 0 THEN p.p_brand || ' ' || CAST(p.p_size AS VARCHAR) || 'th'
              ELSE p.p_brand END AS venue,
         CASE WHEN p.p_type IN ('LARGE', 'PROMO') THEN '[''JournalArticle'']'
              WHEN p.p_type = 'SMALL' THEN '[''JournalArticle'', ''Conference'']'
              WHEN p.p_type = 'MEDIUM' THEN '[''Conference'']'
              WHEN p.p_type = 'STANDARD' THEN '[''Review'']' END AS publicationTypes,
         d.text AS abstract, 2017 + p.p_size % 8 AS year, p.p_size AS citationCount,
         CASE WHEN p.p_size % 3 = 0 THEN 'Proc. ' || CAST(p.p_size AS VARCHAR) || 'th' END AS journal_name,
         CASE WHEN p.p_size % 7 <> 0 THEN CAST(p.p_size AS VARCHAR) END AS journal_volume,
         '1-' || CAST(p.p_size AS VARCHAR) AS journal_pages
  FROM part p LEFT JOIN documents d ON d.doc_id = p.p_partkey),
raw_authors AS (
  SELECT w.paperId, CASE WHEN w.cust % 50 <> 0 THEN w.cust END AS authorId,
         c.c_name AS name, w.cust AS position
  FROM (SELECT DISTINCT CAST(l.l_partkey AS VARCHAR) AS paperId, o.o_custkey AS cust
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey) w
  JOIN customer c ON c.c_custkey = w.cust),
cleaned AS (
  SELECT paperId, CASE WHEN field_query = ' Big Data' THEN 'Big Data' ELSE field_query END AS field_query,
         title, url, venue, publicationTypes, abstract, year, citationCount, journal_name, journal_volume
  FROM raw_papers
  WHERE venue IS NOT NULL AND publicationTypes IS NOT NULL AND abstract IS NOT NULL),
cat0 AS (
  SELECT *, CASE WHEN strpos(coalesce(venue, ''), 'Workshop') > 0 THEN '[''Workshop'']'
                 ELSE publicationTypes END AS t1 FROM cleaned),
cat1 AS (
  SELECT *, CASE WHEN strpos(coalesce(t1, ''), 'Conference') > 0 THEN '[''Conference'']'
                 ELSE t1 END AS t2 FROM cat0),
categorized AS (
  SELECT paperId, field_query, title, venue, abstract, year, journal_name,
         substr(t2, 3, length(t2) - 4) AS publicationTypes,
         CASE WHEN substr(t2, 3, length(t2) - 4) IN ('Workshop', 'Conference') THEN ''
              ELSE journal_volume END AS journal_volume
  FROM cat1 WHERE t2 IN ('[''JournalArticle'']', '[''Conference'']', '[''Workshop'']')),
cat_v AS (SELECT * FROM categorized WHERE journal_volume IS NOT NULL),
named AS (
  SELECT *, CASE WHEN publicationTypes IN ('Conference', 'Workshop') THEN venue END AS proceedings,
            CASE WHEN publicationTypes = 'JournalArticle' THEN venue END AS journal
  FROM cat_v),
edition0 AS (
  SELECT *, nullif(regexp_extract(proceedings, '(\\d+)(?:st|nd|rd|th)', 1), '') AS e_proc,
            nullif(regexp_extract(journal_name, '(\\d+)(?:st|nd|rd|th)', 1), '') AS e_jour
  FROM named),
with_edition AS (
  SELECT *, CASE WHEN proceedings IS NOT NULL AND coalesce(e_proc, e_jour) IS NULL
                 THEN right(CAST(year AS VARCHAR), 2) ELSE coalesce(e_proc, e_jour) END AS edition,
            CASE WHEN proceedings IS NOT NULL AND e_jour IS NULL
                 THEN right(CAST(year AS VARCHAR), 2) ELSE e_jour END AS edition_literal
  FROM edition0),
conf AS (SELECT paperId, CAST(edition AS BIGINT) AS edition, CAST(year AS BIGINT) AS year
         FROM with_edition WHERE publicationTypes = 'Conference'),
author_lists AS (
  SELECT paperId, count(*) AS n_authors, arg_max(authorId, position) AS last_author,
         arg_min(authorId, position) AS first_author,
         string_agg(CAST(authorId AS VARCHAR), ', ' ORDER BY position) AS authorIds
  FROM raw_authors WHERE authorId IS NOT NULL GROUP BY paperId),
cleaned_authors AS (SELECT c.paperId, a.* EXCLUDE (paperId) FROM cleaned c JOIN author_lists a ON a.paperId = c.paperId)
"""

CLEAN = {
    "clean_papers": with_graph(
        "SELECT paperId, field_query, title, url, venue, publicationTypes, abstract, year, citationCount, "
        "journal_name, journal_volume FROM cleaned",
        RAW_CTES),
    "categorize_publication": with_graph(
        "SELECT paperId, publicationTypes, journal_volume FROM cat_v", RAW_CTES),
    "aggregate_paper_authors": with_graph(
        "SELECT paperId, n_authors, last_author, authorIds FROM cleaned_authors", RAW_CTES),
    "list_columns_to_strings": with_graph(
        "SELECT paperId, authorIds FROM cleaned_authors", RAW_CTES),
    "corresponding_author": with_graph(
        "SELECT paperId, first_author AS corresponding_author FROM cleaned_authors", RAW_CTES),
    "venue_names": with_graph("SELECT paperId, proceedings, journal FROM named", RAW_CTES),
    "extract_edition": with_graph("SELECT paperId, edition FROM with_edition", RAW_CTES),
    "extract_edition_literal": with_graph(
        "SELECT paperId, edition_literal AS edition FROM with_edition", RAW_CTES),
    "parse_list_literals": with_graph("""
SELECT paperId, CAST(len(items) AS BIGINT) AS n_types, array_to_string(items, '|') AS types
FROM (SELECT paperId,
             string_split(replace(substr(publicationTypes, 2, length(publicationTypes) - 2), '''', ''), ', ')
               AS items
      FROM raw_papers WHERE publicationTypes IS NOT NULL) x
""", RAW_CTES),
    "finalize_keywords": with_graph("""
SELECT paperId, lower(replace(title, ' ', ',')) || ',' || lower(field_query) AS keywords FROM cleaned
""", RAW_CTES),
    "split_by_type": with_graph("""
SELECT paperId, publicationTypes AS type,
       CASE WHEN publicationTypes <> 'JournalArticle' THEN CAST(edition AS BIGINT) END AS edition
FROM with_edition
""", RAW_CTES),
    "clone_previous_edition": with_graph("""
SELECT paperId, edition, year FROM conf
UNION ALL SELECT paperId || 'a', edition - 1, year - 1 FROM conf
""", RAW_CTES),
    "dedupe_keep_first": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
                 l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
                 l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn
      FROM lineitem) x
WHERE rn = 1
""",
}


def _h(seed: str, *exprs: str) -> str:
    """Seeded hash draw: first 15 hex digits of md5 as a number."""
    parts = ", ".join([f"'{seed}'"] + [f"CAST({e} AS VARCHAR)" for e in exprs])
    return f"('0x' || substr(md5(concat_ws('|', {parts})), 1, 15))::BIGINT"


def _sample_sql(rows_sql: str, k_expr: str, pool_sql: str, seed: str, slack: int,
                exclude_sql: str | None = None, self_excluded: bool = False) -> str:
    excl = ""
    if exclude_sql:
        excl += (f" AND NOT EXISTS (SELECT 1 FROM ({exclude_sql}) e "
                 "WHERE e.r = d.r AND e.pick = p.key)")
    if self_excluded:
        excl += " AND p.key <> d.r"
    return f"""
s_rows AS (SELECT r, {k_expr} AS k FROM ({rows_sql}) x),
s_pool AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS idx
           FROM (SELECT DISTINCT key FROM ({pool_sql}) y) z),
s_n AS (SELECT count(*) AS n FROM s_pool),
s_draws AS (
  SELECT s.r, j.draw, {_h(seed, 's.r', 'j.draw')} % s_n.n AS idx
  FROM (SELECT r, unnest(range(0, k + {slack})) AS draw FROM s_rows) j
  JOIN s_rows s ON s.r = j.r CROSS JOIN s_n),
s_cand AS (
  SELECT d.r, d.draw, p.key AS pick FROM s_draws d JOIN s_pool p ON p.idx = d.idx
  WHERE TRUE {excl}),
s_first AS (SELECT r, pick, min(draw) AS draw FROM s_cand GROUP BY r, pick),
s_ranked AS (SELECT r, pick, row_number() OVER (PARTITION BY r ORDER BY draw) AS rank FROM s_first),
s_out AS (SELECT x.r, CAST(x.rank AS BIGINT) AS rank, x.pick FROM s_ranked x JOIN s_rows s ON s.r = x.r
          WHERE x.rank <= s.k)
"""


SYNTH = {
    "assign_reviewers": with_graph(
        "SELECT r AS paperId, rank, pick FROM s_out",
        _sample_sql("SELECT paperId AS r FROM paper", f"2 + {_h('nrev', 'r')} % 2",
                    "SELECT authorId AS key FROM wrote", "rev", 20,
                    exclude_sql="SELECT paperId AS r, authorId AS pick FROM wrote")),
    "assign_comments": with_graph(
        "SELECT r AS paperId, rank, pick FROM s_out",
        _sample_sql("SELECT paperId AS r FROM paper", f"2 + {_h('nrev', 'r')} % 2",
                    "SELECT item_id AS key FROM benchmark", "comment", 20)),
    "synthetic_citations": with_graph(
        "SELECT r AS paperId, rank, pick FROM s_out",
        _sample_sql("SELECT paperId AS r FROM paper", f"15 + {_h('ncite', 'r')} % 36",
                    "SELECT paperId AS key FROM paper", "cite", 40, self_excluded=True)),
    "assign_locations": with_graph(f"""
SELECT p.paperId, c.location FROM paper p
JOIN (SELECT n_name AS location, row_number() OVER (ORDER BY n_name) - 1 AS idx
      FROM (SELECT DISTINCT n_name FROM nation) x) c
  ON c.idx = {_h('loc', 'p.paperId')} % (SELECT count(DISTINCT n_name) FROM nation)
"""),
    "assign_affiliations": with_graph(f"""
SELECT a.authorId, c.affiliation,
       CASE WHEN c.affiliation IN (SELECT n_name FROM nation WHERE n_nationkey < 12)
            THEN 'university' ELSE 'company' END AS affiliation_type
FROM author a
JOIN (SELECT n_name AS affiliation, row_number() OVER (ORDER BY n_name) - 1 AS idx
      FROM (SELECT DISTINCT n_name FROM nation) x) c
  ON c.idx = {_h('aff', 'a.authorId')} % (SELECT count(DISTINCT n_name) FROM nation)
"""),
}
ALGORITHMS.update(CLEAN)
ALGORITHMS.update(SYNTH)


# --- sources, profiling, keywords ------------------------------------------

# ASCII punctuation (Python's string.punctuation).
_ASCII_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PUNCT = ("[" + __import__("re").escape(_ASCII_PUNCT) + "]").replace("'", "''")
_STOP = "'i', 'me', 'my', 'myself', 'we', 'our', 'ours', 'ourselves', 'you', 'you''re', 'you''ve', 'you''ll', 'you''d', 'your', 'yours', 'yourself', 'yourselves', 'he', 'him', 'his', 'himself', 'she', 'she''s', 'her', 'hers', 'herself', 'it', 'it''s', 'its', 'itself', 'they', 'them', 'their', 'theirs', 'themselves', 'what', 'which', 'who', 'whom', 'this', 'that', 'that''ll', 'these', 'those', 'am', 'is', 'are', 'was', 'were', 'be', 'been', 'being', 'have', 'has', 'had', 'having', 'do', 'does', 'did', 'doing', 'a', 'an', 'the', 'and', 'but', 'if', 'or', 'because', 'as', 'until', 'while', 'of', 'at', 'by', 'for', 'with', 'about', 'against', 'between', 'into', 'through', 'during', 'before', 'after', 'above', 'below', 'to', 'from', 'up', 'down', 'in', 'out', 'on', 'off', 'over', 'under', 'again', 'further', 'then', 'once', 'here', 'there', 'when', 'where', 'why', 'how', 'all', 'any', 'both', 'each', 'few', 'more', 'most', 'other', 'some', 'such', 'no', 'nor', 'not', 'only', 'own', 'same', 'so', 'than', 'too', 'very', 's', 't', 'can', 'will', 'just', 'don', 'don''t', 'should', 'should''ve', 'now', 'd', 'll', 'm', 'o', 're', 've', 'y', 'ain', 'aren', 'aren''t', 'couldn', 'couldn''t', 'didn', 'didn''t', 'doesn', 'doesn''t', 'hadn', 'hadn''t', 'hasn', 'hasn''t', 'haven', 'haven''t', 'isn', 'isn''t', 'ma', 'mightn', 'mightn''t', 'mustn', 'mustn''t', 'needn', 'needn''t', 'shan', 'shan''t', 'shouldn', 'shouldn''t', 'wasn', 'wasn''t', 'weren', 'weren''t', 'won', 'won''t', 'wouldn', 'wouldn''t'"


def _noun_keywords() -> str:
    """The marked sentences counted and turned into weights, tokens scored, nouns counted."""
    seed = ", ".join(f"('{w}', '{p}', '{x}', {n})" for w, p, x, n in seed_tokens())
    kinds = {"word": "word", "end3": "right(word, 3)", "end2": "right(word, 2)", "prev": "prev", "next": "next",
             "prior": "''"}
    described = " UNION ALL ".join(f"SELECT '{k}' AS kind, {e} AS value, noun FROM seed" for k, e in kinds.items())
    joins = "\n  ".join(f"LEFT JOIN weights w_{k} ON w_{k}.kind = '{k}' AND w_{k}.value = {e}"
                        for k, e in kinds.items() if k != "prior")
    return f"""
WITH seed(word, prev, next, noun) AS (VALUES {seed}),
counts AS (
  SELECT kind, value, count(*) FILTER (noun) AS nouns, count(*) FILTER (NOT noun) AS others
  FROM ({described}) d GROUP BY 1, 2),
odds AS (SELECT kind, value, round(ln((2 * nouns + 1) / (2 * others + 1)) * 1000) AS odds
         FROM counts WHERE nouns + others >= 2),
prior AS (SELECT odds AS prior FROM odds WHERE kind = 'prior'),
weights AS (SELECT kind, value, odds - prior AS weight FROM odds, prior WHERE kind <> 'prior'),
arrs AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(lower(text), '{_PUNCT}', '', 'g'),
                                                       '[ \\t\\n\\r\\f]+'), lambda w: w <> '') AS arr FROM documents),
tok AS (SELECT doc_id, arr[i] AS word, coalesce(arr[nullif(i - 1, 0)], '') AS prev, coalesce(arr[i + 1], '') AS next, i AS pos
        FROM (SELECT doc_id, arr, unnest(range(1, len(arr) + 1)) AS i FROM arrs) a),
scored AS (
  SELECT t.doc_id, t.pos, t.word AS term,
         (SELECT prior FROM prior) + coalesce(w_word.weight, 0) + coalesce(w_end3.weight, 0) + coalesce(w_end2.weight, 0)
         + coalesce(w_prev.weight, 0) + coalesce(w_next.weight, 0) AS score
  FROM tok t
  {joins}
  WHERE t.word NOT IN ({_STOP})),
terms AS (
  SELECT doc_id, pos, term FROM scored WHERE score > 0 AND NOT regexp_full_match(term, '[0-9]+')
  UNION ALL
  SELECT doc_id, 4611686018427387904 AS pos, lower(source) AS term FROM documents WHERE source IS NOT NULL),
counted AS (SELECT doc_id, term, count(*) AS c, min(pos) AS first FROM terms GROUP BY 1, 2),
ranked AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY c DESC, first) AS rank
           FROM counted),
top AS (SELECT r.*, lower(d.source) AS f FROM ranked r JOIN documents d USING (doc_id) WHERE rank <= 4),
flags AS (SELECT doc_id, max(CASE WHEN term = f THEN 1 ELSE 0 END) AS has, max(rank) AS last
          FROM top GROUP BY doc_id)
SELECT t.doc_id, CAST(t.rank AS BIGINT) AS rank,
       CASE WHEN fl.has = 0 AND t.rank = fl.last THEN t.f ELSE t.term END AS term
FROM top t JOIN flags fl USING (doc_id)
"""


MISC = {
    "extract_keywords": f"""
WITH tok AS (
  SELECT doc_id, unnest(arr) AS term, generate_subscripts(arr, 1) AS pos
  FROM (SELECT doc_id, string_split_regex(regexp_replace(lower(text), '{_PUNCT}', '', 'g'),
                                          '[ \\t\\n\\r\\f]+') AS arr FROM documents) d),
terms AS (
  SELECT doc_id, pos, term FROM tok WHERE term <> '' AND term NOT IN ({_STOP})
  UNION ALL
  SELECT doc_id, 4611686018427387904 AS pos, lower(source) AS term FROM documents
  WHERE source IS NOT NULL),
counted AS (SELECT doc_id, term, count(*) AS c, min(pos) AS first FROM terms GROUP BY 1, 2),
ranked AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY c DESC, first) AS rank
           FROM counted),
top AS (SELECT r.*, lower(d.source) AS f FROM ranked r JOIN documents d USING (doc_id) WHERE rank <= 4),
flags AS (SELECT doc_id, max(CASE WHEN term = f THEN 1 ELSE 0 END) AS has, max(rank) AS last
          FROM top GROUP BY doc_id)
SELECT t.doc_id, CAST(t.rank AS BIGINT) AS rank,
       CASE WHEN fl.has = 0 AND t.rank = fl.last THEN t.f ELSE t.term END AS term
FROM top t JOIN flags fl USING (doc_id)
""",
    "extract_noun_keywords": _noun_keywords(),
    "value_counts": with_graph("""
SELECT publicationTypes AS value, count(*) AS count FROM raw_papers
WHERE publicationTypes IS NOT NULL GROUP BY 1
""", RAW_CTES),
    "null_profile": with_graph("""
SELECT c.column_name, c.non_null, n.n_rows - c.non_null AS nulls, n.n_rows
FROM (UNPIVOT (SELECT count(paperId) AS paperId, count(field_query) AS field_query,
                      count(title) AS title, count(url) AS url, count(venue) AS venue,
                      count(publicationTypes) AS publicationTypes, count(abstract) AS abstract,
                      count(year) AS year, count(citationCount) AS citationCount,
                      count(journal_name) AS journal_name, count(journal_volume) AS journal_volume,
                      count(journal_pages) AS journal_pages FROM raw_papers)
      ON COLUMNS(*) INTO NAME column_name VALUE non_null) c,
     (SELECT count(*) AS n_rows FROM raw_papers) n
""", RAW_CTES),
    "papers_of_author": with_graph("""
SELECT authorId, count(*) AS n_rows FROM (
  SELECT DISTINCT r.row_no, r.kind, trim(a.item) AS authorId
  FROM load_rows r, unnest(string_split(r.authorIds, ',')) AS a(item)) x
WHERE authorId <> ''
GROUP BY authorId
""", LOAD_CTES),
    "flatten_papers": """
SELECT CAST(p_partkey AS VARCHAR) AS paperId, p_name AS title, 'p/' || CAST(p_partkey AS VARCHAR) AS url,
       'V-' || p_brand AS venue,
       CASE WHEN p_size % 5 <> 0 THEN '[''JournalArticle'', ''' || p_type || ''']' END AS publicationTypes,
       CASE WHEN p_size % 3 <> 0 THEN p_name || ' "quoted"' END AS abstract,
       CAST(2017 + p_size % 8 AS INTEGER) AS year, CAST(p_size AS INTEGER) AS citationCount,
       CASE WHEN p_size % 7 <> 0 THEN 'J-' || p_brand END AS journal_name,
       CASE WHEN p_size % 7 <> 0 THEN CAST(p_size AS VARCHAR) END AS journal_volume,
       CASE WHEN p_size % 7 <> 0 THEN '1-' || CAST(p_size AS VARCHAR) END AS journal_pages
FROM part
""",
    "flatten_authors": with_graph("""
SELECT CAST(w.paperId AS VARCHAR) AS paperId, CAST(a.authorId AS VARCHAR) AS authorId, a.name,
       CASE WHEN a.authorId % 10 <> 0 THEN a.affiliation ELSE '' END AS affiliations
FROM wrote w JOIN author a ON a.authorId = w.authorId
"""),
    "flatten_citations": """
SELECT CAST(conv_id AS VARCHAR) AS paperId, CAST(turn AS VARCHAR) AS citationId,
       concat_ws('; ', nullif(role, 'system'), CAST(conv_id AS VARCHAR)) AS authorIds,
       concat_ws('; ', role, text) AS authorNames
FROM conversations WHERE conv_id % 10 <> 0
""",
    "union_tagged": with_graph(f"""
SELECT paperId, keyword AS field_query FROM contains WHERE keyword IN {COMMUNITY_TERMS_SQL}
"""),
    "csv_round_trip": "SELECT doc_id, text, lang, source FROM documents",
    "csv_round_trip_split": "SELECT doc_id, text, lang, source, n_chars FROM documents",
}
ALGORITHMS.update(MISC)

ALGORITHMS["community_papers"] = with_graph(f"""
SELECT DISTINCT p.kind, p.name, p.paperId FROM published_in p
WHERE p.kind IN ('Journal', 'Conference')
  AND p.paperId IN (SELECT paperId FROM contains WHERE keyword IN {COMMUNITY_TERMS_SQL})
""")

ALGORITHMS["citation_reach_khop"] = with_graph("""
SELECT topPaperId, paperId, min(hops) AS hops FROM (
  SELECT t.paperId AS topPaperId, c.src AS paperId, CAST(1 AS BIGINT) AS hops
  FROM top_paper t JOIN cites c ON c.dst = t.paperId
  UNION ALL
  SELECT t.paperId, c2.src, CAST(2 AS BIGINT)
  FROM top_paper t JOIN cites c1 ON c1.dst = t.paperId JOIN cites c2 ON c2.dst = c1.src) x
WHERE paperId <> topPaperId
GROUP BY topPaperId, paperId
""", COMMUNITY_CTES)

# the CSV round trip of the load files must give exactly the same graph
ALGORITHMS["graph_counts_from_csv"] = BUILD["graph_counts"]

# The pipeline keeps every categorised paper that has an author (keywords
# and citations exist for all of them) and doubles the conference rows.
ALGORITHMS["process_papers_counts"] = with_graph("""
SELECT CASE WHEN c.publicationTypes = 'JournalArticle' THEN 'Journal'
            ELSE c.publicationTypes END AS type,
       count(*) * CASE WHEN c.publicationTypes = 'Conference' THEN 2 ELSE 1 END AS n_rows
FROM cat_v c JOIN author_lists a ON a.paperId = c.paperId
GROUP BY c.publicationTypes
""", RAW_CTES)



def _processed_rows() -> str:
    """The pipeline's load files row by row: draws, keywords and editions put together."""
    import re

    def sample(prefix: str, *args, **kwargs) -> str:
        return re.sub(r"\bs_", f"{prefix}_", _sample_sql(*args, **kwargs))

    reviewers = sample("rv", "SELECT paperId AS r FROM pp", f"2 + {_h('nrev', 'r')} % 2",
                       "SELECT authorId AS key FROM raw_authors WHERE authorId IS NOT NULL "
                       "AND paperId IN (SELECT paperId FROM pp)", "rev", 20,
                       exclude_sql="SELECT paperId AS r, authorId AS pick FROM raw_authors WHERE authorId IS NOT NULL")
    comments = sample("cm", "SELECT paperId AS r FROM pp", f"2 + {_h('nrev', 'r')} % 2",
                      "SELECT item_id AS key FROM benchmark", "comment", 20)
    cites = sample("ci", "SELECT paperId AS r FROM raw_papers", f"15 + {_h('ncite', 'r')} % 36",
                   "SELECT paperId AS key FROM raw_papers", "cite", 40, self_excluded=True)
    return with_graph("""
SELECT * FROM kept
UNION ALL
SELECT * REPLACE (year - 1 AS year, edition - 1 AS edition, paperId || 'a' AS paperId)
FROM kept WHERE type = 'Conference'
""", RAW_CTES + f""",
pp AS (
  SELECT c.paperId, c.field_query, c.title, w.url, c.abstract, c.year, w.citationCount, c.publicationTypes,
         c.proceedings, c.journal, c.journal_volume, c.edition, a.first_author, a.authorIds
  FROM with_edition c JOIN author_lists a ON a.paperId = c.paperId JOIN cleaned w ON w.paperId = c.paperId),
{reviewers}, {comments}, {cites},
rv_list AS (SELECT r, string_agg(CAST(pick AS VARCHAR), ', ' ORDER BY rank) AS reviewers FROM rv_out GROUP BY r),
cm_list AS (SELECT c.r, string_agg(b.text, ';' ORDER BY c.rank) AS comments
            FROM cm_out c JOIN benchmark b ON b.item_id = c.pick GROUP BY c.r),
ci_list AS (SELECT r, string_agg(pick, ', ' ORDER BY rank) AS Citations FROM ci_out GROUP BY r),
place AS (SELECT n_name AS location, row_number() OVER (ORDER BY n_name) - 1 AS idx
          FROM (SELECT DISTINCT n_name FROM nation) x),
k_tok AS (
  SELECT paperId, unnest(arr) AS term, generate_subscripts(arr, 1) AS pos
  FROM (SELECT paperId, string_split_regex(regexp_replace(lower(abstract), '{_PUNCT}', '', 'g'),
                                           '[ \\t\\n\\r\\f]+') AS arr FROM pp) x),
k_terms AS (
  SELECT paperId, pos, term FROM k_tok WHERE term <> '' AND term NOT IN ({_STOP})
  UNION ALL SELECT paperId, 4611686018427387904, lower(field_query) FROM pp),
k_counted AS (SELECT paperId, term, count(*) AS c, min(pos) AS first FROM k_terms GROUP BY 1, 2),
k_top AS (SELECT * FROM (SELECT paperId, term, row_number() OVER (PARTITION BY paperId ORDER BY c DESC, first) AS rank
                         FROM k_counted) x WHERE rank <= 4),
k_last AS (SELECT t.paperId, max(t.rank) AS last, bool_or(t.term = lower(p.field_query)) AS has
           FROM k_top t JOIN pp p ON p.paperId = t.paperId GROUP BY 1),
k_list AS (
  SELECT t.paperId, string_agg(CASE WHEN NOT l.has AND t.rank = l.last THEN lower(p.field_query) ELSE t.term END, ','
                               ORDER BY t.rank) || ',' || lower(any_value(p.field_query)) AS keywords
  FROM k_top t JOIN k_last l ON l.paperId = t.paperId JOIN pp p ON p.paperId = t.paperId GROUP BY 1),
kept AS (
  SELECT CAST(p.year AS BIGINT) AS year, CAST(p.citationCount AS BIGINT) AS citationCount,
         CASE WHEN publicationTypes <> 'JournalArticle' THEN TRY_CAST(p.edition AS BIGINT) END AS edition,
         CAST(2 + {_h('nrev', 'p.paperId')} % 2 AS BIGINT) AS number_reviewers,
         CAST(p.first_author AS BIGINT) AS corresponding_author,
         CASE WHEN publicationTypes = 'JournalArticle' THEN 'Journal' ELSE publicationTypes END AS type,
         p.paperId, p.title, p.url, p.abstract, l.location AS venue, 'Y' AS approved, p.publicationTypes,
         p.proceedings, CASE WHEN publicationTypes = 'JournalArticle' THEN p.journal END AS journal_name,
         CASE WHEN publicationTypes = 'JournalArticle' THEN p.journal_volume END AS journal_volume,
         k.keywords, p.authorIds, rv.reviewers, cm.comments, ci.Citations
  FROM pp p
  JOIN place l ON l.idx = {_h('loc', 'p.paperId')} % (SELECT count(*) FROM place)
  JOIN k_list k ON k.paperId = p.paperId
  LEFT JOIN rv_list rv ON rv.r = p.paperId
  LEFT JOIN cm_list cm ON cm.r = p.paperId
  JOIN ci_list ci ON ci.r = p.paperId)""")


ALGORITHMS["process_papers_rows"] = _processed_rows()

# SCC of the load-file CITES graph: string keys, stubs included, self-loops
# ignored; a component is named by its smallest paperId.
ALGORITHMS["scc_loaded_cites"] = _recursive(with_graph("""
SELECT v.paperId, least(v.paperId, coalesce(min(m.src), v.paperId)) AS componentId
FROM (SELECT paperId FROM l_paper
      UNION SELECT dst FROM l_cites WHERE dst NOT IN (SELECT paperId FROM l_paper)) v
LEFT JOIN (SELECT r.src, r.dst FROM l_reach r JOIN l_reach b ON b.src = r.dst AND b.dst = r.src) m
  ON m.dst = v.paperId
GROUP BY v.paperId
""", LOAD_CTES + """,
l_edge AS (SELECT src, dst FROM l_cites WHERE src <> dst),
l_reach(src, dst) AS (
  SELECT src, dst FROM l_edge
  UNION
  SELECT r.src, e.dst FROM l_reach r JOIN l_edge e ON e.src = r.dst)
"""))

MORE = {
    "flatten_then_clean": """
SELECT CAST(p_partkey AS VARCHAR) AS paperId, 'Big Data' AS field_query,
       '[''JournalArticle'', ''' || p_type || ''']' AS publicationTypes, p_name || ' "quoted"' AS abstract,
       CAST(2017 + p_size % 8 AS INTEGER) AS year
FROM part WHERE p_size % 5 <> 0 AND p_size % 3 <> 0
""",
    "authors_info": with_graph(f"""
SELECT a.authorId, a.name, p.affiliation AS Affiliations,
       CASE WHEN p.affiliation IN (SELECT affiliation FROM unis) THEN 'university' ELSE 'company' END
         AS Affiliation_type
FROM (SELECT CAST(authorId AS BIGINT) AS authorId, min(name) AS name FROM raw_authors
      WHERE authorId IS NOT NULL GROUP BY 1) a
JOIN inst p ON p.idx = {_h('aff', 'a.authorId')} % (SELECT count(*) FROM inst)
""", RAW_CTES + """,
unis AS (SELECT n_name AS affiliation FROM (
           SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS place FROM nation) x
         WHERE place >= 1 AND place < 12),
firms AS (SELECT s_name AS affiliation FROM (
            SELECT s_name, row_number() OVER (ORDER BY s_suppkey) - 1 AS place FROM supplier) x
          WHERE place < 10),
inst AS (SELECT affiliation, row_number() OVER (ORDER BY affiliation) - 1 AS idx
         FROM (SELECT affiliation FROM unis UNION SELECT affiliation FROM firms) x)
"""),
    "dedupe_papers": with_graph("""
SELECT paperId, CASE WHEN CAST(paperId AS BIGINT) % 3 = 0 AND 'AAA' < field_query THEN 'AAA'
                     ELSE field_query END AS field_query, title, year
FROM raw_papers
""", RAW_CTES),
    "attach_keywords_citations": with_graph("""
SELECT paperId, lower(replace(title, ' ', ',')) || ',' || lower(field_query) AS keywords,
       paperId || ', 1' AS Citations
FROM cleaned WHERE CAST(paperId AS BIGINT) % 4 <> 0 AND CAST(paperId AS BIGINT) % 5 <> 0
""", RAW_CTES),
    "project_partial": with_graph("""
SELECT (SELECT count(*) FROM paper WHERE paperId % 3 <> 0) AS nodeCount,
       (SELECT count(*) FROM cites WHERE src % 3 <> 0 AND dst % 3 <> 0
          AND src IN (SELECT paperId FROM paper) AND dst IN (SELECT paperId FROM paper)) AS relationshipCount,
       k.keys
FROM (SELECT unnest(['integer', 'text']) AS keys) k
"""),
    "scc_same_edition": _recursive(with_graph("""
SELECT p.paperId, coalesce(min(m.src), p.paperId) AS componentId
FROM paper p LEFT JOIN (
  SELECT r.src, r.dst FROM e_reach r JOIN e_reach b ON b.src = r.dst AND b.dst = r.src) m ON m.dst = p.paperId
GROUP BY p.paperId
""", """
e_edge AS (SELECT c.src, c.dst FROM cites c JOIN paper a ON a.paperId = c.src JOIN paper b ON b.paperId = c.dst
           WHERE a.citationCount % 20 = b.citationCount % 20),
e_reach(src, dst) AS (
  SELECT src, dst FROM e_edge
  UNION
  SELECT r.src, e.dst FROM e_reach r JOIN e_edge e ON e.src = r.dst)
""")),
}
ALGORITHMS.update(MORE)


# --- incremental load, substring membership, sampling by rank, named projections ------


def _rank_sql(rows_sql: str, k_expr: str, pool_sql: str, seed: str, excluded: str) -> str:
    """Distinct ranks among the eligible members (Floyd's method), then the members themselves."""
    draw = f"({_h(seed, 'r', 'e[1]')} % (n - m + e[1] + 1))"
    return f"""
s_rows AS (SELECT r, {k_expr} AS k FROM ({rows_sql}) x),
s_pool AS (SELECT DISTINCT key FROM ({pool_sql}) y),
s_elig AS (SELECT r, key, row_number() OVER (PARTITION BY r ORDER BY key) - 1 AS place
           FROM s_rows CROSS JOIN s_pool WHERE NOT ({excluded})),
s_n AS (SELECT r, n, least(k, n) AS m FROM s_rows JOIN (SELECT r, count(*) AS n FROM s_elig GROUP BY r) c USING (r)),
s_ranks AS (
  SELECT r, unnest(ranks) AS place, unnest(range(1, m + 1)) AS rank FROM (
    SELECT r, m, list_reduce(
      list_concat([[]::BIGINT[]], list_transform(range(0, m), lambda i: [i])),
      lambda held, e: list_append(held, CASE WHEN list_contains(held, {draw}) THEN n - m + e[1] ELSE {draw} END)) AS ranks
    FROM s_n) x),
s_out AS (SELECT d.r AS paperId, d.rank::BIGINT AS rank, e.key AS pick FROM s_ranks d JOIN s_elig e USING (r, place))
"""


LATER = {
    "merge_store_wrote": with_graph("SELECT * FROM l_wrote", LOAD_CTES),
    "merge_store_published_in": with_graph("SELECT * FROM l_published_in", LOAD_CTES),
    "merge_store_papers": with_graph("""
SELECT paperId, title, url, year, citationCount, false AS stub FROM l_paper
UNION ALL
SELECT DISTINCT dst, NULL, NULL, NULL, NULL, true FROM l_cites WHERE dst NOT IN (SELECT paperId FROM l_paper)
""", LOAD_CTES),
    "papers_of_author_substring": with_graph("""
SELECT a.authorId, count(r.authorIds) AS n_rows
FROM (SELECT DISTINCT authorId FROM author_rows) a LEFT JOIN load_rows r ON contains(r.authorIds, a.authorId)
GROUP BY a.authorId
""", LOAD_CTES),
    "assign_reviewers_by_rank": with_graph("SELECT * FROM s_out", _rank_sql(
        "SELECT paperId AS r FROM paper", f"2 + {_h('nrev', 'r')} % 2", "SELECT authorId AS key FROM wrote", "rev",
        "EXISTS (SELECT 1 FROM wrote w WHERE w.paperId = r AND w.authorId = key)")),
    "synthetic_citations_by_rank": with_graph("SELECT * FROM s_out", _rank_sql(
        "SELECT paperId AS r FROM paper", f"15 + {_h('ncite', 'r')} % 36", "SELECT paperId AS key FROM paper", "cite",
        "key = r")),
    "named_projection_algorithms": f"""
SELECT a.paperId, a.score, b.componentId
FROM ({ALGORITHMS["pagerank_cites"]}) a JOIN ({ALGORITHMS["scc_cites"]}) b ON a.paperId = b.paperId""",
}
# no cycles: rounds beyond the longest paths that still carry weight change nothing
LATER["pagerank_after_merge"] = _pagerank_cites_sql(60, which="""src > dst AND src % 10 <> 1
  AND (SELECT citationCount FROM paper WHERE paperId = src) % 20
    = (SELECT citationCount FROM paper WHERE paperId = dst) % 20""").replace(
    " AS (SELECT DISTINCT src, dst", " AS MATERIALIZED (SELECT DISTINCT src, dst")
LATER["citation_reach_estimates"] = f"""
SELECT topPaperId, count(*) AS n_papers, true AS within_bound
FROM ({ALGORITHMS["citation_reach_khop"]}) x GROUP BY topPaperId"""
LATER["condensation_levels"] = _recursive(with_graph("""
SELECT c.componentId, count(*) AS n_papers, any_value(l.level) AS level
FROM comp c JOIN (SELECT c, max(d) AS level FROM path GROUP BY c) l ON l.c = c.componentId
GROUP BY c.componentId
""", """
e_edge AS (SELECT c.src, c.dst FROM cites c JOIN paper a ON a.paperId = c.src JOIN paper b ON b.paperId = c.dst
           WHERE a.citationCount % 20 = b.citationCount % 20),
e_reach(src, dst) AS (
  SELECT src, dst FROM e_edge
  UNION
  SELECT r.src, e.dst FROM e_reach r JOIN e_edge e ON e.src = r.dst),
comp AS MATERIALIZED (
  SELECT p.paperId, coalesce(min(m.src), p.paperId) AS componentId
  FROM paper p LEFT JOIN (
    SELECT r.src, r.dst FROM e_reach r JOIN e_reach b ON b.src = r.dst AND b.dst = r.src) m ON m.dst = p.paperId
  GROUP BY p.paperId),
arc AS MATERIALIZED (
  SELECT DISTINCT a.componentId AS s, b.componentId AS t
  FROM e_edge e JOIN comp a ON a.paperId = e.src JOIN comp b ON b.paperId = e.dst WHERE a.componentId <> b.componentId),
path(c, d) AS (
  SELECT DISTINCT componentId, 0 FROM comp
  UNION
  SELECT t, d + 1 FROM path JOIN arc ON s = c)
"""))
ALGORITHMS.update(LATER)
