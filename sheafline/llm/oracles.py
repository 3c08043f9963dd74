"""SQL for those queries of this package that SQL can express over whole tables."""

from __future__ import annotations

GROUP = r"""coalesce(nullif(lower(trim(doc_group,' ')),''), nullif(lower(trim(coalesce(
  CASE WHEN k IS NOT NULL AND k>0 AND k+1<len(q) THEN q[k+1] WHEN (k IS NULL OR k=0) AND len(q)>1 THEN q[len(q)-1] END,
  string_split(regexp_replace(q[len(q)],'\.[^.]*$',''),'__')[1]),' ')),''))"""
RECORDS = f"""SELECT *, {GROUP} AS grp FROM (SELECT *, coalesce(list_position(list_transform(q, lambda x: lower(trim(x,' ')) IN ('positiv','positive','negativ','negative')), true),0) AS k
  FROM (SELECT *, string_split(path,'/') AS q FROM doc_record))"""
ALL_LINES = f"""SELECT rec_id, grp, CAST(no AS INTEGER) AS line_no, regexp_replace(lower(line),'[^\\p{{L}}]+','','g') AS key FROM (
  SELECT rec_id, grp, unnest(l) AS line, generate_subscripts(l,1) AS no FROM (SELECT rec_id, grp, string_split(text,chr(10)) AS l FROM ({RECORDS}) WHERE text<>''))"""
LINES = ALL_LINES.replace("WHERE text<>''", "WHERE ocr_used=false AND text<>''")
P5 = f"""WITH l AS MATERIALIZED (SELECT * FROM ({LINES}) WHERE length(key)>=30 AND grp IS NOT NULL),
  f AS (SELECT grp, key FROM l GROUP BY grp, key HAVING count(DISTINCT rec_id)>=6) SELECT l.rec_id, l.line_no FROM l JOIN f USING (grp, key)"""

P5_CLEAN = f"""WITH l AS MATERIALIZED (SELECT * FROM ({ALL_LINES}) WHERE length(key)>=30 AND grp IS NOT NULL),
  g AS (SELECT grp, count(*) AS n FROM ({RECORDS}) GROUP BY grp),
  f AS (SELECT grp, key FROM l JOIN g USING (grp) GROUP BY grp, key HAVING count(DISTINCT rec_id)>=6 AND count(DISTINCT rec_id)>=any_value(g.n)*0.05),
  d AS (SELECT rec_id, list(DISTINCT line_no) AS gone FROM l JOIN f USING (grp, key) GROUP BY rec_id)
  SELECT rec_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(string_split(text,chr(10)), lambda x, i: NOT list_contains(gone, i::INTEGER)),chr(10)) END AS text
  FROM doc_record LEFT JOIN d USING (rec_id)"""

P2 = """WITH RECURSIVE e AS (SELECT DISTINCT a, b FROM (SELECT lower(trim(slug_a,' ')) a, lower(trim(slug_b,' ')) b FROM group_link) WHERE a<>'' AND b<>''),
  u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  r(a, b) AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM r JOIN u ON r.b=u.a)
  SELECT a AS slug_a, b AS slug_b FROM r WHERE a<b"""

P2_WHOLE = f"""WITH RECURSIVE e AS (SELECT DISTINCT a, b FROM (SELECT lower(trim(slug_a,' ')) a, lower(trim(slug_b,' ')) b FROM group_link) WHERE a<>'' AND b<>''),
  u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  r(a, b) AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM r JOIN u ON r.b=u.a),
  m AS (SELECT a, least(a, min(b)) AS root FROM r GROUP BY a)
  SELECT coalesce(root, grp) AS entity, count(*) AS n_records, count(DISTINCT grp) AS n_groups, 1::BIGINT AS n_splits FROM ({RECORDS}) LEFT JOIN m ON m.a=grp GROUP BY 1"""
P7_COVER = "SELECT doc_id, length(text) AS placed, 0::BIGINT AS gaps, 0::BIGINT AS over FROM documents WHERE length(text)>0"
P9_COVER = "SELECT doc_id, length(text) AS reached, 0::BIGINT AS gaps, 0::BIGINT AS bad FROM documents WHERE length(text)>0"

WORDS = r"list_filter(regexp_split_to_array(lower(text),'[^\p{L}\p{N}]+'), lambda x: x<>'')"


def shingles(table: str, key: str, k: int) -> str:
    return (f"SELECT {key} AS id, hash(list_aggregate(list_slice(w,i,i+{k - 1}),'string_agg',' ')) AS h FROM "
            f"(SELECT {key}, w, unnest(range(1, len(w)-{k - 2})) AS i FROM (SELECT {key}, {WORDS} AS w FROM {table} WHERE text<>'') WHERE len(w)>={k})")


P8 = f"SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM ({shingles('documents', 'doc_id', 12)}) d JOIN ({shingles('eval_item', 'item_id', 12)}) i USING (h)"

# Pairs of equal texts, and pairs of different ones that share shingles counted by a join; sets by a recursive walk.
P3 = f"""WITH RECURSIVE s AS MATERIALIZED (SELECT DISTINCT id, h FROM ({shingles('doc_record', 'rec_id', 3)})),
  n AS MATERIALIZED (SELECT id, count(*) AS n, CAST(sum(h::HUGEINT) AS VARCHAR) AS all_h FROM s GROUP BY id),
  rep AS MATERIALIZED (SELECT all_h, n, min(id) AS rep FROM n GROUP BY all_h, n), mem AS MATERIALIZED (SELECT n.id, rep.rep FROM n JOIN rep USING (all_h, n)),
  t AS MATERIALIZED (SELECT s.* FROM s JOIN rep ON s.id=rep.rep),
  c AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM t x JOIN t y ON x.h=y.h AND x.id<y.id GROUP BY 1,2),
  e AS MATERIALIZED (SELECT a, b FROM c JOIN n p ON p.id=a JOIN n q ON q.id=b WHERE c >= 0.6*(p.n+q.n-c) - 1e-9),
  u AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e UNION SELECT a, a FROM e UNION SELECT b, b FROM e UNION SELECT rep, rep FROM rep),
  r(a, b) AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM r JOIN u ON r.b=u.a)
  """
P3_SETS = P3 + """SELECT d.rec_id, coalesce(m.s, d.rec_id) AS set_id FROM doc_record d LEFT JOIN (SELECT p.id, min(r.b) AS s FROM mem p JOIN r ON r.a=p.rep GROUP BY p.id) m ON m.id=d.rec_id"""
P3 += "SELECT DISTINCT p.id AS rec_a, q.id AS rec_b FROM r JOIN mem p ON p.rep=r.a JOIN mem q ON q.rep=r.b WHERE p.id<q.id"

# The batch in order, one step a record: whoever resembles nothing old and nothing accepted joins the list.
P4 = f"""WITH RECURSIVE s AS MATERIALIZED (SELECT DISTINCT id, h FROM ({shingles('doc_record', 'rec_id', 3)} UNION ALL {shingles('doc_batch', 'rec_id', 3)})),
  n AS MATERIALIZED (SELECT id, count(*) AS n FROM s GROUP BY id),
  o AS MATERIALIZED (SELECT rec_id AS id, row_number() OVER (ORDER BY batch_no NULLS FIRST, rec_id) AS k FROM doc_batch),
  c AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM s y JOIN o ON o.id=y.id JOIN s x ON x.h=y.h AND x.id<>y.id LEFT JOIN o p ON p.id=x.id WHERE coalesce(p.k,0)<o.k GROUP BY 1,2),
  e AS MATERIALIZED (SELECT a, b FROM c JOIN n p ON p.id=a JOIN n q ON q.id=b WHERE c >= 0.6*(p.n+q.n-c) - 1e-9),
  q AS MATERIALIZED (SELECT o.id, o.k, coalesce(bool_or(e.a IS NOT NULL AND p.id IS NULL),false) AS old, coalesce(list(e.a) FILTER (p.id IS NOT NULL),[]) AS near
    FROM o LEFT JOIN e ON e.b=o.id LEFT JOIN o p ON p.id=e.a GROUP BY 1,2),
  r(k, ok) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT q.k, CASE WHEN old OR list_has_any(ok, near) THEN ok ELSE list_append(ok, q.id) END FROM r JOIN q ON q.k=r.k+1),
  z AS MATERIALIZED (SELECT unnest(ok) AS id FROM (SELECT ok FROM r ORDER BY k DESC LIMIT 1))
  SELECT a AS accepted_id, b AS rec_id FROM e WHERE b NOT IN (SELECT id FROM z) AND (a IN (SELECT id FROM z) OR a NOT IN (SELECT id FROM o))"""

SQL = {"p2_found": P2, "p2_whole": P2_WHOLE, "p3_found": P3, "p3_sets": P3_SETS, "p4_found": P4, "p5_found": P5, "p5_clean": P5_CLEAN, "p7_cover": P7_COVER, "p8_found": P8, "p9_cover": P9_COVER}
