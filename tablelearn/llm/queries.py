"""One registered query per training-data operator: (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F  # noqa: F401

from tablelearn.llm import alignment, balltree, binpack, bpe, decontam, langid, license_scan, neardup, ordinal, periodic, pii, transducer, url_lists
from tablelearn.llm.common import setup, table

QUERIES: dict = {}
ORACLE: dict = {}


def q(fn):
    def run(spark, sf_dir):
        setup(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@q
def op1_bpe(spark, sf_dir):
    """Ids of every text and the text decoded from them, as digests."""
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), vocabulary(), decoded=True))


@q
def op2_licenses(spark, sf_dir):
    """License notices of every text, with the wording differences of the confirmed template."""
    return license_scan.scan(table(spark, sf_dir, "documents")).withColumn("reduction", F.round("reduction", 6))


@q
def op3_langid(spark, sf_dir):
    """Language of every text, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def dated(pages):
    """Captures: every page with a fetch day that follows from its id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2023-01-01").cast("date"),
                                                      F.pmod(F.col("page_id") * 37, F.lit(730)).cast("int")).alias("fetched"))


def _n(c):
    return F.conv(F.substring(F.md5(c.cast("binary")), 1, 6), 16, 10).cast("int")


def lists(pages):
    """Dated list entries over the hosts, domains and path prefixes that the pages have."""
    sites = pages.select(url_lists.host("url").alias("h"), url_lists.path_parts("url").alias("p")).where("h <> ''")
    hosts = sites.select(F.col("h").alias("pattern")).distinct()
    domains = sites.select(F.regexp_extract("h", r"([^.]+\.[^.]+)$", 1).alias("pattern")).where("pattern <> ''").distinct()
    paths = sites.where(F.size("p") > 0).select(F.concat("h", F.lit("/"), F.col("p")[0]).alias("pattern")).distinct()
    n = _n(F.col("pattern"))
    parts = [(hosts, "hosts", "block", "host", n % 3 == 0, [("add", n % 500), ("remove", n % 500 + n % 211 + 1),
                                                           ("add", n % 500 + n % 211 + 61)]),
             (domains, "domains", "block", "domain", n % 5 == 0, [("add", n % 300)]),
             (paths, "paths", "block", "prefix", n % 4 == 1, [("add", n % 400), ("remove", n % 400 + n % 97 + 1)]),
             (hosts, "trusted", "allow", "host", n % 7 == 0, [("add", n % 600), ("remove", n % 600 + 45)])]
    out = None
    for df, name, effect, kind, some, steps in parts:
        turns = F.explode(F.array(*[F.struct(F.lit(v).alias("verb"), d.cast("int").alias("d")) for v, d in steps]))
        e = df.where(some).select("pattern", turns.alias("t")).select(
            F.lit(name).alias("list"), F.lit(effect).alias("effect"), F.lit(kind).alias("kind"), "pattern", "t.verb",
            F.date_add(F.lit("2023-01-01").cast("date"), F.col("t.d")).alias("day"))
        out = e if out is None else out.unionByName(e)
    return out


@q
def op4_url_filter(spark, sf_dir):
    """Every page judged by the list entries that were active on its fetch day."""
    pages = table(spark, sf_dir, "pages")
    return url_lists.filter_captures(dated(pages), lists(pages))


ORACLE["op4_url_filter"] = r"""
WITH p AS (
  SELECT page_id, DATE '2023-01-01' + CAST((page_id * 37) % 730 AS INTEGER) AS fetched,
    regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages),
c AS (
  SELECT page_id, fetched, list_filter(string_split(regexp_extract(rest, '^[^/?#]*/([^?#]*)', 1), '/'), lambda x: x <> '') AS parts,
    regexp_replace(lower(regexp_replace(regexp_replace(regexp_extract(rest, '^([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '\.$', '') AS h
  FROM p),
pat AS (
  SELECT DISTINCT 'host' AS kind, h AS pattern FROM c WHERE h <> ''
  UNION SELECT 'domain', regexp_extract(h, '([^.]+\.[^.]+)$', 1) FROM c WHERE regexp_matches(h, '[^.]+\.[^.]+$')
  UNION SELECT 'prefix', h || '/' || parts[1] FROM c WHERE h <> '' AND len(parts) > 0),
n AS (SELECT kind, pattern, CAST('0x' || substr(md5(pattern), 1, 6) AS INTEGER) AS n FROM pat),
e AS (
  SELECT 'hosts' AS list, 'block' AS effect, kind, pattern, 1 AS act, n % 500 AS d FROM n WHERE kind = 'host' AND n % 3 = 0
  UNION ALL SELECT 'hosts', 'block', kind, pattern, 0, n % 500 + n % 211 + 1 FROM n WHERE kind = 'host' AND n % 3 = 0
  UNION ALL SELECT 'hosts', 'block', kind, pattern, 1, n % 500 + n % 211 + 61 FROM n WHERE kind = 'host' AND n % 3 = 0
  UNION ALL SELECT 'domains', 'block', kind, pattern, 1, n % 300 FROM n WHERE kind = 'domain' AND n % 5 = 0
  UNION ALL SELECT 'paths', 'block', kind, pattern, 1, n % 400 FROM n WHERE kind = 'prefix' AND n % 4 = 1
  UNION ALL SELECT 'paths', 'block', kind, pattern, 0, n % 400 + n % 97 + 1 FROM n WHERE kind = 'prefix' AND n % 4 = 1
  UNION ALL SELECT 'trusted', 'allow', kind, pattern, 1, n % 600 FROM n WHERE kind = 'host' AND n % 7 = 0
  UNION ALL SELECT 'trusted', 'allow', kind, pattern, 0, n % 600 + 45 FROM n WHERE kind = 'host' AND n % 7 = 0),
state AS (
  SELECT c.page_id, e.list, e.effect, arg_max(e.act, e.d) AS act
  FROM c JOIN e ON ((e.kind = 'host' AND e.pattern = c.h)
      OR (e.kind = 'domain' AND e.pattern = regexp_extract(c.h, '([^.]+\.[^.]+)$', 1))
      OR (e.kind = 'prefix' AND len(c.parts) > 0 AND e.pattern = c.h || '/' || c.parts[1]))
    AND DATE '2023-01-01' + CAST(e.d AS INTEGER) <= c.fetched
  GROUP BY ALL),
v AS (
  SELECT page_id, bool_or(effect = 'block') AND NOT bool_or(effect = 'allow') AS blocked, count(*) AS n_matches,
    string_agg(list, ',' ORDER BY list) AS lists FROM state WHERE act = 1 GROUP BY page_id)
SELECT c.page_id, c.fetched, coalesce(blocked, false) AS blocked, coalesce(n_matches, 0) AS n_matches, coalesce(lists, '') AS lists
FROM c LEFT JOIN v USING (page_id)
"""


@q
def op5_topk(spark, sf_dir):
    """Five highest inner products for every vector whose id 50 divides."""
    return balltree.top_k(table(spark, sf_dir, "embeddings"))


ORACLE["op5_topk"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT DISTINCT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@q
def op6_quality(spark, sf_dir):
    """Expected grade of every text, and whether it is likely good and clean."""
    docs = table(spark, sf_dir, "documents")
    graded = ordinal.grade(docs, ordinal.fit(docs, ordinal.rated(table(spark, sf_dir, "labels"))))
    return graded.withColumnRenamed("selected", "kept")


@q
def op7_decontamination(spark, sf_dir):
    """Documents that hold at least 80 % of the 5-word shingles of a benchmark item."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumn(
        "containment", F.round("containment", 6))


_PLAIN = r"""
  SELECT {id} AS id, list_filter(list_transform(
    regexp_split_to_array(coalesce(text, ''), '[ \t\n\r\x0b\x0c]+'),
    lambda w: trim(lower(w), '!"#$%&''()*+,-./:;<=>?@[\]^_`{{|}}~')), lambda w: w <> '') AS w FROM {table}"""
_SHINGLES = """
  SELECT DISTINCT id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM {of} WHERE len(w) > 0)"""
ORACLE["op7_decontamination"] = f"""
WITH d AS ({_PLAIN.format(id="doc_id", table="documents")}), b AS ({_PLAIN.format(id="item_id", table="benchmark")}),
ds AS ({_SHINGLES.format(of="d")}), bs AS ({_SHINGLES.format(of="b")}),
n AS (SELECT id, count(*) AS item_shingles FROM bs GROUP BY id),
m AS (SELECT ds.id AS doc_id, bs.id AS item_id, count(*) AS shared FROM bs JOIN ds ON bs.s = ds.s GROUP BY ALL)
SELECT doc_id, item_id, item_shingles, shared, round(shared / item_shingles, 6) AS containment
FROM m JOIN n ON n.id = m.item_id WHERE shared >= 0.8 * item_shingles
"""


@q
def op8_neardup(spark, sf_dir):
    """Components of documents whose sets of 3-word shingles overlap by 85 % or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), n=3, percent=85)


ORACLE["op8_neardup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id AS id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t\n\r\x0b\x0c]+'), lambda w: w <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS s
  FROM (SELECT id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
m AS (SELECT a.id AS a, b.id AS b, count(*) AS m FROM s a JOIN s b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
e AS (SELECT a, b FROM m JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
r(id, root) AS (
  SELECT id, id FROM d
  UNION SELECT e2.b, r.root FROM r JOIN (SELECT a, b FROM e UNION ALL SELECT b, a FROM e) e2 ON e2.a = r.id),
c AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT c.id AS doc_id, coalesce(n.n, 0) AS n_shingles, c.root AS component_id, c.id = c.root AS kept FROM c LEFT JOIN n USING (id)
"""


@q
def op9_sharding(spark, sf_dir):
    """All documents into 24 shards of near equal bytes; copies stay together."""
    return binpack.shard_documents(table(spark, sf_dir, "documents"))


@q
def op10_pii(spark, sf_dir):
    """Personal data of every text: counts and digest of the base spans, and all spans."""
    found = pii.detect(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{k}" for k in pii.KINDS), F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op11_periodic_table(docs):
    return periodic.report(periodic.runs(periodic.looped(docs)))


@q
def op11_periodic_runs(spark, sf_dir):
    """Periodic runs of words in every text, periodic tails written into a tenth of them first."""
    return op11_periodic_table(table(spark, sf_dir, "documents"))


@q
def op12_alignment(spark, sf_dir):
    """Tokens of two tokenisers aligned in every text: groups, links, and how common the linked id pairs are."""
    import public_tokenizers as p

    return alignment.digests(table(spark, sf_dir, "documents"), vocabulary(), p.path("piece_bpe_32k.model"))


@q
def op13_transducer(spark, sf_dir):
    """Ids of every text by ranks, and the bytes decoded from them, as digests."""
    import public_tokenizers as p

    docs = table(spark, sf_dir, "documents")
    return transducer.digests(transducer.encode(docs, p.path("byte_bpe_50k.tiktoken"), p.PATTERN, decoded=True))
