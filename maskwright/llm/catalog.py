"""The registered queries of this subpackage, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskwright.llm import (bitplanes, jaccard, language, licences, merkle, neighbours, packing, periodic, quality,
                           scoring, sharding, tiling, urls)
from maskwright.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op10_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


def tokenizer(name: str):
    """Where a public tokenizer lies on the machine that asks."""
    def find() -> str:
        import public_tokenizers

        return public_tokenizers.path(name)
    return find


def as_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op1_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan_licences(table(spark, folder, "documents"))
    return found.withColumns({"sentence_ids": F.array_join("sentence_ids", ","), "licences": F.array_join("licences", ",")})


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return tiling.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"))


# The rules of the query: verdict, host, path.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages"), [urls.host_rule(*rule) for rule in URL_RULES])


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.where(~language.held_out()))
    return language.predict(docs.select("doc_id", language.held_out().alias("held_out"), "text"), model).drop("text")


def op6_kd_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, folder, "documents"), 40)
    return placed.drop("lines").withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = scoring.fit(scoring.marked_by(docs, table(spark, folder, "labels")))
    return scoring.score(docs, model)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return as_digests(packing.pack(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json")))


def op9_bit_planes(spark: SparkSession, folder: str) -> DataFrame:
    files = bitplanes.write_ids(table(spark, folder, "documents"), scratch_path(spark, "token-ids"),
                                tokenizer("word_bpe_49k.json"), gaps=False, end_id=1)
    return bitplanes.read_ids(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0) & F.col("n_chars").isNotNull()
    more = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields]
    leaves = docs.select("doc_id", "lang", merkle.leaf_digest(*map(F.col, fields)).alias("leaf"),
                         F.when(changed, merkle.leaf_digest(*more)).alias("tampered"))
    proven = merkle.manifest(leaves, "leaf", "lang", ["doc_id"])
    proven = proven.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("siblings")))
    return proven.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("siblings")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _made_periodic(docs: DataFrame) -> DataFrame:
    """doc_id and words; by a checksum of its id, a tenth of the documents repeats a stretch of its words to the end."""
    held = docs.select("doc_id", periodic.words_of(F.col("text")).alias("words"))
    held = held.withColumns({"n": F.size("words"), "h": F.crc32(F.col("doc_id").cast("string"))})
    g = F.floor(F.col("h") / 10)
    held = held.withColumn("a", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), (g % F.col("n")).cast("int")))
    held = held.withColumn("p", (F.floor((F.col("n") - F.col("a")) / (g % 8 + 3)) + 1).cast("int"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", place(i)))
    return held.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("words")).alias("words"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find_runs(_made_periodic(table(spark, folder, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    found = found.withColumn("best", best)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    start, length, period = -F.col("best.before"), F.col("best.length"), -F.col("best.shorter")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), ((length * 1000 - length * 1000 % period) / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels.where(~quality.held_out()))
    scored = quality.score(docs.select("doc_id", quality.held_out().alias("held_out"), "text"), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


QUERIES = {f.__name__: f for f in (
    op1_licence_scan, op2_decontamination, op3_nearest_neighbours, op4_url_filter, op5_language_id, op6_kd_sharding,
    op7_lm_scoring, op8_packing, op9_bit_planes, op10_ngram_jaccard, op11_merkle_manifest,
    op12_periodic_runs, op13_quality_classifier)}

_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licence_sql() -> str:
    """The sentences and rules as SQL lists; rules are applied one after the other by a list reduction."""
    critical = "|".join(licences.CRITICAL)
    known = "MAP {" + ", ".join(f"{_quoted(s)}: {_quoted(i)}" for s, i in licences.SENTENCES.items()) + "}"
    rules = "[" + ", ".join(
        f"{{'l': {_quoted(n)}, 'r': {_quoted('<' + '><'.join(i) + '>')}, 'g': {str(g).lower()}}}"
        for (n, i), g in zip(licences.RULES, licences.guarded(licences.RULES))) + "]"
    norm = "trim(regexp_replace({}, '[^a-z0-9]+', ' ', 'g'))"
    for before, owner, behind in licences.OWNERS:
        norm = f"regexp_replace({norm}, '{before}.{{{{1,{licences.OWNER_CHARS}}}}}?{behind}', '{before}{owner}{behind}', 'g')"
    spdx = licences.EXPRESSION
    return rf"""
WITH cut AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{licences.ABBREVIATED}', ' \1', 'g'), '[.!?;]+[ 	
]+|
[ 	
]*
'), lambda s: regexp_matches(s, '{critical}')) AS s,
    {known} AS known FROM documents),
units AS (SELECT doc_id, known, list_filter(flatten(list_transform(s, lambda s: CASE
        WHEN NOT contains(s, chr(10)) OR map_contains(known, {norm.format('s')}) THEN [s]
        ELSE string_split(s, chr(10)) END)), lambda s: regexp_matches(s, '{critical}')) AS u FROM cut),
spoken AS (SELECT doc_id, known, flatten(list_transform(list_transform(u, lambda s: {norm.format('s')}), lambda s:
        CASE WHEN starts_with(s, '{spdx}') AND NOT map_contains(known, s) AND regexp_matches(s, ' (or|and) ')
        THEN list_transform(string_split_regex(replace(substr(s, {len(spdx) + 1}), ' or later', ' orlater'), ' (?:or|and) '),
            lambda p: '{spdx}' || replace(p, 'orlater', 'or later')) ELSE [s] END)) AS u FROM units),
found AS (SELECT doc_id, coalesce(list_transform(u, lambda s: coalesce(known[s], '?')), []) AS f FROM spoken),
state AS (SELECT doc_id, f, list_reduce(list_concat([{{'l': '', 'r': coalesce(list_aggregate(list_transform(f,
        lambda s: '<' || s || '>'), 'string_agg', ''), ''), 'g': false}}], {rules}), lambda a, b: CASE WHEN contains(a.r, b.r)
        AND NOT (b.g AND contains(a.r, b.r || '<?>')) THEN {{'l': CASE WHEN contains(',' || a.l || ',', ',' || b.l || ',') THEN a.l WHEN a.l = '' THEN b.l
            ELSE a.l || ',' || b.l END, 'r': replace(a.r, b.r, '|'), 'g': false}} ELSE a END) AS z FROM found)
SELECT doc_id, array_to_string(list_filter(f, lambda s: s != '?'), ',') AS sentence_ids, z.l AS licences,
    CAST(length(regexp_replace(replace(z.r, '<?>', ''), '[^<]', '', 'g')) AS INTEGER) AS unmatched,
    CAST(len(list_filter(f, lambda s: s = '?')) AS INTEGER) AS unknown FROM state"""


def _counted(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _climb_sql(name: str, start: str, group: str) -> str:
    """One row per leaf and level, until the group has one node; siblings are lists of their digests by side."""
    at = lambda slot: f"max(node) FILTER (WHERE pos % 2 = {slot}) OVER run_"
    beside = lambda slot: f"CASE WHEN pos % 2 = {1 - slot} THEN coalesce({at(slot)}, '') ELSE '' END"
    return f"""
{name}(id, {group}, pos, n, node, path) AS (SELECT id, {group}, pos, n, leaf, CAST([] AS STRUCT(l VARCHAR, r VARCHAR)[])
    FROM {start} UNION ALL SELECT id, {group}, pos // 2, (n + 1) // 2, sha256({at(0)} || coalesce({at(1)}, '')),
    list_append(path, {{'l': {beside(0)}, 'r': {beside(1)}}}) FROM {name} WHERE n > 1
    WINDOW run_ AS (PARTITION BY {group}, pos // 2))"""


def _merkle_sql() -> str:
    """The checksum is worked out bit by bit: an element of the list is a byte to take in or, as -1, one step."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = lambda changed: "sha256(" + " || ".join(
        _counted("(n_chars + 1)" if changed and f == "n_chars" else f) for f in fields) + ")"
    crc = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, e:
    CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, (c & 1) * 3988292384) END))"""
    return f"""
WITH RECURSIVE leaves AS (SELECT row_number() OVER () AS id, doc_id, lang, {leaf(False)} AS leaf,
    CASE WHEN {crc} % 7 = 0 AND n_chars IS NOT NULL THEN {leaf(True)} END AS tampered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, {leaf(False)}) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n FROM documents),
{_climb_sql("climb", "leaves", "lang")},
tops AS (SELECT row_number() OVER () AS id, 0 AS one, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS n, lang, leaf FROM (SELECT DISTINCT lang, node AS leaf FROM climb WHERE n = 1)),
{_climb_sql("rise", "tops", "one")},
proofs AS (SELECT leaves.*, climb.node AS subroot, rise.node AS root, list_concat(climb.path, rise.path) AS path
    FROM leaves JOIN climb ON leaves.id = climb.id AND climb.n = 1
    JOIN tops ON leaves.lang IS NOT DISTINCT FROM tops.lang JOIN rise ON rise.id = tops.id AND rise.n = 1),
folded AS (SELECT *, list_reduce(list_concat([{{'l': coalesce(tampered, leaf), 'r': ''}}], path),
    lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(list_aggregate(list_transform(path, lambda s: s.l || s.r),
    'string_agg', ''), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded"""


_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)

ORACLES = {
    "op1_licence_scan": _licence_sql(),
    "op3_nearest_neighbours": """
WITH valid AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0),
unit AS (SELECT vec_id, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) AS n FROM valid),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]),
    lambda a, b: a + b) / (q.n * c.n) AS score FROM unit q JOIN unit c ON q.vec_id % 50 = 0 AND c.vec_id != q.vec_id
    AND len(q.e) = len(c.e))
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM pairs
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""",
    "op4_url_filter": rf"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES {_RULE_ROWS}),
parts AS (SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
fits AS (SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(verdict, length(rule_host || rule_path)) AS verdict FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY host, path)
SELECT page_id, parts.host, parts.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits ON parts.host = fits.host AND parts.path = fits.path""",
    "op11_merkle_manifest": _merkle_sql(),
    "op10_ngram_jaccard": rf"""
WITH RECURSIVE words AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
runs AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b FROM runs x JOIN runs y ON x.h = y.h AND x.doc_id != y.doc_id
    GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(doc_id, c) AS (SELECT doc_id, doc_id FROM documents
    UNION SELECT pairs.b, reach.c FROM reach JOIN pairs ON pairs.a = reach.doc_id),
least_ AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN least_ USING (doc_id)""",
}
