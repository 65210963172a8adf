"""Registered queries of the operators and their SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.llm import convtrie, decontaminate, lmscore, merkle, mixing, ngramjoin, packing, pii, substrings, tokencount, topk, toxicity, urlfilter
from corpusflow.llm.common import fold, load, stored

QUERIES, SQL = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_top_k(spark: SparkSession, base: str) -> DataFrame:
    v = load(spark, base, "embeddings")
    return topk.top_k(v, F.col("vec_id") % 50 == 0, 5)


SQL["op1_exact_top_k"] = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, max(list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@query
def op2_benchmark_decontamination(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, base, "documents").select("doc_id", "text")
    return decontaminate.decontaminate(docs, load(spark, base, "benchmark")).drop("text")


SQL["op2_benchmark_decontamination"] = r"""
WITH dw AS (SELECT rowid AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
bw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bl AS (SELECT item_id, w, least(10, len(w)) AS m FROM bw WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s
      FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM bl)),
ms AS (SELECT DISTINCT m FROM p),
dpos AS (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, ms WHERE len(w) >= m),
occ AS (SELECT d.r, d.i, d.m, p.item_id FROM dpos d JOIN p ON p.m = d.m AND p.s = array_to_string(d.w[d.i:d.i + d.m - 1], ' ')),
hit AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS x FROM occ) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
        FROM (SELECT DISTINCT r, item_id::VARCHAR AS k FROM occ) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN its USING (r)"""


@query
def op3_toxicity(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, base, "documents").select("doc_id", "text")
    learn = load(spark, base, "labels").where(fold(F.col("doc_id")) != 0)
    return (toxicity.classify(docs, toxicity.fit(docs, learn))
            .select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted"))


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op4_token_counts(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, base, "documents").select("doc_id", "text")
    return tokencount.count_tokens(docs, vocabulary("word_bpe_49k.json")).drop("text")


@query
def op5_ngram_jaccard_join(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, base, "documents").select("doc_id", "text")
    return ngramjoin.classes(docs).select("doc_id", "n_shingles", "component_id")


SQL["op5_ngram_jaccard_join"] = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM d),
e AS (SELECT r, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.r AS x, b.r AS y FROM e a JOIN e b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
l AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
c(r, t) AS (SELECT r, r FROM s UNION SELECT c.r, l.y FROM c JOIN l ON l.x = c.t)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, (SELECT min(o.doc_id) FROM c JOIN s o ON o.r = c.t WHERE c.r = s.r) AS component_id FROM s"""


@query
def op6_substring_dedup(spark: SparkSession, base: str) -> DataFrame:
    return substrings.repeated_passages(load(spark, base, "documents").select("doc_id", "text"))


RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


@query
def op7_url_filters(spark: SparkSession, base: str) -> DataFrame:
    pages = load(spark, base, "pages")
    return urlfilter.judge(pages.select("page_id", "url"), RULES, urlfilter.unigrams(pages)).drop("url")


@query
def op8_personal_data(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, base, "documents").select("doc_id", "text")
    return pii.find_spans(docs, pii.train(docs)).drop("text")


@query
def op9_mixing_sources(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, base, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL["op9_mixing_sources"] = r"""
WITH q AS (SELECT *, CASE WHEN length(text) > 0 THEN power(length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g'))::DOUBLE
                               / length(text)::DOUBLE, 8.0::DOUBLE) ELSE 1.0::DOUBLE END AS w0 FROM documents),
d AS (SELECT d.doc_id, d.source, md5(d.text) AS h, len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             -ln((('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE) / CASE WHEN d.w0 > 0 THEN d.w0 ELSE 1.0::DOUBLE END AS key
      FROM q d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::BIGINT AS w FROM s),
c AS (SELECT *, sum(source_size) OVER o - source_size AS size_to, sum(w) OVER o - w AS w_to,
             sum(source_size) OVER () AS all_size, sum(w) OVER () AS all_w
      FROM w WINDOW o AS (ORDER BY source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
r AS (SELECT *, (1.5::DOUBLE * all_size::DOUBLE - (2 * size_to)::DOUBLE) / (all_w - w_to)::DOUBLE AS rate FROM c),
f AS (SELECT *, w * rate >= 2 * source_size AS capped FROM r),
t AS (SELECT source, source_size, CASE WHEN capped THEN (2 * source_size)::DOUBLE ELSE w::DOUBLE * final END AS target
      FROM f, (SELECT arg_min(rate, size_to) FILTER (NOT capped) AS final FROM f)),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2)::BIGINT ELSE 0 END AS epochs FROM t),
x AS (SELECT d.*, e.source_size, e.target, e.epochs, greatest(0, e.target - e.epochs * e.source_size) AS rest,
             sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size, h ROWS UNBOUNDED PRECEDING) - size AS before
      FROM d JOIN e ON e.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN size > 0 AND epochs < 2 AND before + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM x"""


@query
def op10_lm_scoring(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, base, "documents").select("doc_id", "text")
    return lmscore.score(docs, fold(F.col("doc_id")) == 1)


def even_crc(ident):
    return F.crc32(ident.cast("string").cast("binary")) % 2 == 0


@query
def op11_merkle_manifest(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, base, "documents")
    tampered = F.when(even_crc(F.col("doc_id")), F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proofs = merkle.verify(merkle.manifest(docs, {"text": tampered}))
    proof = F.sha2(F.array_join(merkle.siblings(F.col("path")), "").cast("binary"), 256)
    return proofs.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


def crc32_sql(number: str) -> str:
    """Unsigned CRC-32 of a decimal number: eight steps of its rule per digit."""
    step = "list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b))"
    digits = f"list_transform(string_split({number}::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    return f"xor(4294967295, list_reduce({digits}, lambda c, b: {step}, 4294967295::BIGINT))"


SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, *, CASE WHEN {crc32_sql('doc_id')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS tampered FROM documents),
e AS (SELECT r, doc_id, source, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
             coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(tampered) || ':' || tampered, '-') AS other FROM d),
lf AS (SELECT r, doc_id, sha256(head || body) AS leaf, sha256(head || other) AS claim, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
              row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, sha256(head || body)) - 1 AS idx FROM e),
up(tree, lvl, idx, h, n) AS (
  SELECT tree, 0, idx, leaf, count(*) OVER (PARTITION BY tree) FROM lf
  UNION ALL
  SELECT tree, lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY tree, lvl, idx // 3, n),
sub AS (SELECT tree, lvl, h FROM up WHERE n = 1),
top(lvl, idx, h, n) AS (
  SELECT 0, tree, h, count(*) OVER () FROM sub
  UNION ALL
  SELECT lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY lvl, idx // 3, n),
runs AS (SELECT tree, lvl, idx // 3 AS up, list(h ORDER BY idx) AS hs FROM up WHERE n > 1 GROUP BY ALL),
truns AS (SELECT lvl, idx // 3 AS up, list(h ORDER BY idx) AS hs FROM top WHERE n > 1 GROUP BY ALL),
fold(r, tree, lvl, idx, proof, acc) AS (
  SELECT r, tree, 0::BIGINT, idx, '', claim FROM lf
  UNION ALL
  SELECT f.r, f.tree, f.lvl + 1, f.idx // 3, f.proof || array_to_string(list_concat(g.hs[:f.idx % 3], g.hs[f.idx % 3 + 2:]), ''),
         sha256(array_to_string(g.hs[:f.idx % 3], '') || f.acc || array_to_string(g.hs[f.idx % 3 + 2:], ''))
  FROM fold f JOIN runs g ON g.tree = f.tree AND g.lvl = f.lvl AND g.up = f.idx // 3),
low AS (SELECT r, tree, proof, acc FROM fold QUALIFY row_number() OVER (PARTITION BY r ORDER BY lvl DESC) = 1),
tfold(r, lvl, idx, proof, acc) AS (
  SELECT r, 0::BIGINT, tree, proof, acc FROM low
  UNION ALL
  SELECT f.r, f.lvl + 1, f.idx // 3, f.proof || array_to_string(list_concat(g.hs[:f.idx % 3], g.hs[f.idx % 3 + 2:]), ''),
         sha256(array_to_string(g.hs[:f.idx % 3], '') || f.acc || array_to_string(g.hs[f.idx % 3 + 2:], ''))
  FROM tfold f JOIN truns g ON g.lvl = f.lvl AND g.up = f.idx // 3),
done AS (SELECT r, proof, acc FROM tfold QUALIFY row_number() OVER (PARTITION BY r ORDER BY lvl DESC) = 1)
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = top.h AS verified
FROM lf JOIN done USING (r) JOIN sub ON sub.tree = lf.tree, top WHERE top.n = 1"""


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations of the trie query: the first turns of each conversation are those of the one its block of
    five ids starts with."""
    turns, pieces = convtrie.ordered(conversations)
    sizes = pieces.groupBy("conv_id").agg(F.max("n").alias("n"))
    keep = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    convs = sizes.select("conv_id", "n", keep.alias("keep"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    convs = convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("_n")), "base", "left")
    lead = F.least("keep", F.coalesce("_n", F.lit(0)))
    convs = stored(convs.select("conv_id", "base", "keep", lead.alias("lead"), (lead + F.greatest(F.col("n") - F.col("keep"), F.lit(0))).alias("length")), "trie-convs")
    turns = stored(turns.join(pieces.join(convs, "conv_id").drop("n"), ["conv_id", "piece"]), "trie-own")
    heads = turns.where("conv_id = base AND pos < 8").select("base", "pos", "digest", "bytes")
    lent = convs.join(heads, "base").where("pos < keep").select("conv_id", "pos", "digest", "bytes", "length")
    own = turns.where("pos >= keep").select("conv_id", (F.col("pos") - F.col("keep") + F.col("lead")).alias("pos"), "digest", "bytes", "length")
    return lent.unionByName(own), convs.select("conv_id", "length")


@query
def op12_conversation_trie(spark: SparkSession, base: str) -> DataFrame:
    return convtrie.prefix_trie(*rebuilt(load(spark, base, "conversations")))


SQL["op12_conversation_trie"] = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos,
             sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h, strlen(coalesce(text, ''))::BIGINT AS b FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n, {crc32_sql('conv_id')} % 9 AS keep, conv_id - conv_id % 5 AS base FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, t.pos, h, b FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.keep
      UNION ALL
      SELECT c.conv_id, 100000000 + t.pos, h, b FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.keep),
l AS (SELECT conv_id, list(h ORDER BY pos) FILTER (h IS NOT NULL) AS hs, list(b ORDER BY pos) FILTER (h IS NOT NULL) AS bs FROM (SELECT conv_id FROM c) LEFT JOIN r USING (conv_id) GROUP BY conv_id),
k AS (SELECT conv_id, coalesce(hs, []) AS hs, coalesce(bs, []) AS bs, unnest(range(coalesce(len(hs), 0) + 1)) AS depth FROM l),
p AS (SELECT conv_id, depth, len(hs) AS length, CASE WHEN depth = 0 THEN 0 ELSE bs[depth] END AS b, sha256(array_to_string(hs[:depth], ',')) AS node,
             CASE WHEN depth > 0 THEN sha256(array_to_string(hs[:depth - 1], ',')) END AS parent FROM k),
n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(parent) AS parent, (count(*) - 1) * max(b) AS saved, max(length) = depth AS leaf,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256 FROM p GROUP BY node, depth),
a AS (SELECT x.node, n.leaf, n.saved FROM n JOIN p x ON x.conv_id = n.conv_id AND x.depth <= n.depth),
s AS (SELECT node, sum(leaf::INTEGER)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM a GROUP BY node),
kids AS (SELECT parent, count(*) AS n_children FROM n GROUP BY parent)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN s USING (node) LEFT JOIN n u ON u.node = n.parent LEFT JOIN kids ON kids.parent = n.node"""


@query
def op13_best_fit_packing(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack(packing.cut(load(spark, base, "documents"), vocabulary("byte_bpe_50k.json")))
