"""The operators of this subpackage as queries over the test tables, with SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drover.llm import (
    ctw,
    decontamination,
    fingerprints,
    language,
    licenses,
    manifest,
    mixing,
    near,
    packing,
    repeats,
    sharding,
    urls,
    whitening,
)
from drover.llm.shipping import ship

QUERIES = {}
SQL: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(modulus: int):
    """Rows that nothing is learned from; a NULL doc_id is never learned from."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    return F.coalesce(remainder == 0, F.lit(True))


@query
def op1_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files of a tree: source / thousands / hundreds; each 25th is a licence file.

    Licence files whose doc_id is a multiple of 1000 or 250 lie in the source's
    or the thousands' directory, the others beside the documents.
    """
    k = F.col("doc_id")
    top = F.concat_ws("/", "source", (k / 1000).cast("long").cast("string"))
    leaf = F.concat_ws("/", top, ((k / 100).cast("long") % 10).cast("string"))
    files = table(spark, folder, "documents").select(
        "doc_id",
        F.when(k % 1000 == 0, F.concat_ws("/", "source", F.lit("LICENSE")))
        .when(k % 250 == 0, F.concat_ws("/", top, F.lit("LICENSE")))
        .when(k % 25 == 0, F.concat_ws("/", leaf, F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", leaf, F.concat(k.cast("string"), F.lit(".txt"))))
        .alias("path"),
        "text",
    )
    return licenses.scan_licenses(files, windows=True)


def _license_sql() -> str:
    """The licence scan in SQL, with the templates' vectors as values."""
    known = licenses.Templates()
    parts = ", ".join(
        f"('{name}', {number}, {norm:.17e}, '{term}', {weight:.17e})"
        for number, (name, vector, norm) in enumerate(zip(known.names, known.vectors, known.norms))
        for term, weight in vector.items()
    )
    idf = ", ".join(f"('{term}', {value:.17e})" for term, value in known.idf.items())
    return f"""
WITH parts(license, template, length, term, part) AS (VALUES {parts}),
idf(term, idf) AS (VALUES {idf}),
files AS (
    SELECT doc_id, coalesce(text, '') AS text, CASE
        WHEN doc_id % 1000 = 0 THEN source || '/LICENSE'
        WHEN doc_id % 250 = 0 THEN source || '/' || doc_id // 1000 || '/LICENSE'
        WHEN doc_id % 25 = 0 THEN source || '/' || doc_id // 1000 || '/' || doc_id // 100 % 10 || '/LICENSE'
        ELSE source || '/' || doc_id // 1000 || '/' || doc_id // 100 % 10 || '/' || doc_id || '.txt' END AS path
    FROM documents),
placed AS (
    SELECT *, regexp_replace(path, '/[^/]*$', '') AS directory, ends_with(path, '/LICENSE') AS declares FROM files),
notices AS (
    SELECT DISTINCT * FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS notice FROM placed
        UNION ALL SELECT doc_id, array_to_string(string_split(text, chr(10))[1:20], chr(10)) FROM placed
        UNION ALL SELECT doc_id, text FROM placed WHERE declares)),
terms AS (SELECT doc_id, notice, unnest(regexp_extract_all(lower(notice), '{licenses.WORD}')) AS term FROM notices),
weights AS (
    SELECT doc_id, notice, term, count(*) * any_value(coalesce(idf, {known.unseen:.17e})) AS w
    FROM terms LEFT JOIN idf USING (term) GROUP BY doc_id, notice, term),
norms AS (SELECT doc_id, notice, sqrt(sum(w * w)) AS norm FROM weights GROUP BY doc_id, notice),
products AS (
    SELECT doc_id, notice, license, length, sum(w * part) AS product
    FROM weights JOIN parts USING (term) GROUP BY doc_id, notice, template, license, length),
scores AS (
    SELECT doc_id, license, round(least(product / (norm * length), 1e0), 6) AS score
    FROM products JOIN norms USING (doc_id, notice)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license DESC) AS place
    FROM scores WHERE score >= 0.8),
found AS (
    SELECT p.doc_id, path, directory, declares, license, score
    FROM placed p LEFT JOIN ranked r ON p.doc_id = r.doc_id AND place = 1),
declared AS (
    SELECT directory, license FROM found WHERE declares AND license IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY directory ORDER BY score DESC, license DESC) = 1),
nearest AS (
    SELECT f.doc_id, d.directory AS above, d.license FROM found f JOIN declared d
        ON f.directory = d.directory OR starts_with(f.directory, d.directory || '/')
    WHERE f.license IS NULL
    QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(d.directory) DESC) = 1)
SELECT f.doc_id, path, directory, f.license AS own_license, score AS own_score,
    coalesce(f.license, n.license) AS license, above AS inherited_from
FROM found f LEFT JOIN nearest n ON f.doc_id = n.doc_id
"""


SQL["op1_license_scans"] = _license_sql()


@query
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), with_ids=False)


@query
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return fingerprints.compare_with_edits(docs, fingerprints.lexicon(docs))


@query
def op4_context_tree_weighting(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", held_out(10).alias("held_out"))
    return ctw.score(docs)


@query
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return sharding.shuffle_rows(docs, shards=8).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


SQL["op6_url_filters"] = """
WITH rules(rule_host, rule_path, verdict) AS (VALUES
    ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
parts AS (
    SELECT page_id,
        CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
split AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts),
fits AS (
    SELECT s.*, r.rule_host || r.rule_path AS rule, r.verdict,
        row_number() OVER (PARTITION BY s.page_id
            ORDER BY length(r.rule_host) DESC, length(r.rule_path) DESC) AS place
    FROM split s LEFT JOIN rules r
        ON (s.host = r.rule_host OR s.host LIKE '%.' || r.rule_host) AND starts_with(s.path, r.rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""



SQL["op9_near_duplicates"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(words) >= 5
            THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
        ELSE CAST([] AS varchar[]) END) AS shingle
    FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
    SELECT x, y FROM common JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id
    WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT e.y, r.other FROM reach r JOIN edges e ON r.doc_id = e.x)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS bigint) AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN reach r ON d.doc_id = r.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
GROUP BY d.doc_id
"""


@query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~held_out(5)))
    found = language.identify(docs.drop("lang"), model)
    return found.select("doc_id", held_out(5).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op7_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return repeats.measure(docs, repeats.find_repeats(docs))


SQL["op7_suffix_repeats"] = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM t WHERE length(h) >= 400),
windows AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS k FROM places),
repeated AS (
    SELECT doc_id, i FROM windows WHERE k IN (SELECT k FROM windows GROUP BY k HAVING count(*) > 1)),
steps AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS opens
    FROM repeated),
numbered AS (
    SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS span FROM steps),
spans AS (SELECT doc_id, span, min(i) AS low, max(i) + 200 AS high FROM numbered GROUP BY doc_id, span),
gaps AS (
    SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS after FROM spans),
kept AS (
    SELECT g.doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last,
        string_agg(substr(h, 2 * after + 1, 2 * (low - after)), '' ORDER BY low) AS front
    FROM gaps g JOIN t ON g.doc_id = t.doc_id GROUP BY g.doc_id)
SELECT t.doc_id, CAST(length(h) // 2 AS bigint) AS n_bytes,
    CAST(coalesce(n_removed, 0) AS bigint) AS n_removed, CAST(coalesce(n_spans, 0) AS bigint) AS n_spans,
    sha256(unhex(coalesce(front || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM t LEFT JOIN kept ON t.doc_id = kept.doc_id
"""


def benchmark_items(spark: SparkSession, folder: str) -> DataFrame:
    """Test items with their last sentence as the answer."""
    return table(spark, folder, "benchmark").select(
        "item_id", *decontamination.question_and_answer("text")
    )


@query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return decontamination.find_leaks(docs, benchmark_items(spark, folder))


@query
def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    found = whitening.whiten(vectors, whitening.fit(vectors)).drop("embedding")
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", mixing.count_words("text").alias("size"), mixing.draw(["doc_id", "text"]).alias("draw")
    )
    return mixing.mix(docs, by="draw").select("doc_id", "size", "source_size", "target", "taken")


def _mixing_sql(rounds: int = 60) -> str:
    """The mix in SQL, where running sums in order of the draws stand for the thresholds."""
    return rf"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}')) AS bigint) AS size,
        CAST('0x' || substr(md5('0|' || coalesce(CAST(doc_id AS varchar), '-') || '|' || coalesce(text, '-')), 1, 15)
            AS bigint) AS draw
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS double) AS words,
        CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS double) AS weight
    FROM sized GROUP BY source),
levels(step, level) AS (
    SELECT 0, (SELECT 1.5e0 * sum(words) / sum(weight) FROM sources)
    UNION ALL
    SELECT step + 1, (
        SELECT coalesce(
            (1.5e0 * sum(words) - 2e0 * sum(CASE WHEN weight * level > 2 * words THEN words ELSE 0 END))
                / nullif(sum(CASE WHEN weight * level > 2 * words THEN 0 ELSE weight END), 0), level) FROM sources)
    FROM levels WHERE step < {rounds}),
targets AS (
    SELECT source, words, least(2 * words, weight * level) AS target,
        CASE WHEN words > 0 THEN least(floor(least(2 * words, weight * level) / words), 2) ELSE 0 END AS rounds
    FROM sources, levels WHERE step = {rounds}),
summed AS (
    SELECT doc_id, s.source, size, words, target, rounds, target - rounds * words AS rest,
        sum(size) OVER (PARTITION BY s.source ORDER BY draw ROWS UNBOUNDED PRECEDING) AS through
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, CAST(words AS bigint) AS source_size, target,
    CAST(size * (rounds + CASE WHEN through <= rest OR through - size <= rest AND size < 2 * (rest - through + size)
        THEN 1 ELSE 0 END) AS bigint) AS taken
FROM summed
"""


SQL["op12_mixing"] = _mixing_sql()


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose doc_id's CRC-32 is even are verified as copies that have lost their line breaks."""
    docs = table(spark, folder, "documents")
    names = ["doc_id", "source", "lang", "n_chars"]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.when(F.coalesce(even, F.lit(False)), F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = manifest.manifest(docs, columns=[*names, "text"], candidate=[*names, cut])
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _manifest_sql() -> str:
    """The manifest in SQL: every level of a tree as one list of digests."""
    part = "coalesce(CAST(octet_length(encode({0})) AS varchar) || ':' || {0}, '-')".format
    fixed = " || ".join(part(f"CAST({c} AS varchar)") for c in ("doc_id", "source", "lang", "n_chars"))
    step = "xor(a >> 1, 3988292384 * (a & 1))"

    def trees(name: str, start: str) -> str:
        """All levels (tree, level, nodes) above the lists of `start`."""
        return f"""{name}(tree, level, nodes) AS (
    SELECT tree, 0, nodes FROM ({start})
    UNION ALL
    SELECT tree, level + 1, list_transform(range(0, (len(nodes) + 2) // 3),
        lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))
    FROM {name} WHERE len(nodes) > 1)"""

    def paths(name: str, tree: str, leaves: str) -> str:
        """For each leaf (tree, position) and level below the top what lies left and right in its run."""
        return f"""{name} AS (
    SELECT l.tree, position, level,
        array_to_string(nodes[3 * (p // 3) + 1:p], '') AS before,
        array_to_string(nodes[p + 2:3 * (p // 3) + 3], '') AS after
    FROM (SELECT l.tree, position, level, nodes, CAST(position // CAST(pow(3, level) AS bigint) AS bigint) AS p
        FROM {leaves} l JOIN {tree} t ON l.tree IS NOT DISTINCT FROM t.tree WHERE len(nodes) > 1) l)"""

    return f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source AS tree, sha256({fixed} || {part('text')}) AS leaf,
        sha256({fixed} || {part("CASE WHEN doc_id IS NOT NULL AND crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")}) AS candidate
    FROM (SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(
            string_split(CAST(doc_id AS varchar), ''), lambda c: CAST(ascii(c) AS bigint))),
        lambda x, c: list_reduce(list_concat([xor(x, c)], range(8)), lambda a, b: {step})), 4294967295) AS crc
        FROM documents)),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS position FROM leaves),
{trees("lower_", "SELECT tree, list(leaf ORDER BY position) AS nodes FROM placed GROUP BY tree")},
subroots AS (
    SELECT tree AS source, nodes[1] AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS position, 1 AS tree
    FROM lower_ WHERE len(nodes) = 1),
{trees("upper_", "SELECT 1 AS tree, list(subroot ORDER BY position) AS nodes FROM subroots")},
{paths("inner_path", "lower_", "placed")},
{paths("outer_path", "upper_", "subroots")},
steps AS (
    SELECT tree, position, level, before, after FROM inner_path
    UNION ALL
    SELECT p.tree, p.position, 1000 + level, before, after
    FROM placed p JOIN subroots s ON p.tree IS NOT DISTINCT FROM s.source
        JOIN outer_path o ON s.position = o.position),
ways AS (
    SELECT tree, position, string_agg(before || after, '' ORDER BY level) AS siblings,
        list(before ORDER BY level) AS befores, list(after ORDER BY level) AS afters
    FROM steps GROUP BY tree, position),
folded(doc_id, tree, position, node, climbed, befores, afters) AS (
    SELECT doc_id, p.tree, p.position, candidate, 0, befores, afters
    FROM placed p LEFT JOIN ways w ON p.tree IS NOT DISTINCT FROM w.tree AND p.position = w.position
    UNION ALL
    SELECT doc_id, tree, position, sha256(befores[climbed + 1] || node || afters[climbed + 1]), climbed + 1,
        befores, afters
    FROM folded WHERE climbed < len(befores))
SELECT p.doc_id, leaf, subroot, u.nodes[1] AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
    node AS folded_root, node = u.nodes[1] AS verified
FROM placed p
JOIN subroots s ON p.tree IS NOT DISTINCT FROM s.source
JOIN upper_ u ON len(u.nodes) = 1
LEFT JOIN ways w ON p.tree IS NOT DISTINCT FROM w.tree AND p.position = w.position
JOIN folded f ON p.tree IS NOT DISTINCT FROM f.tree AND p.position = f.position AND climbed = coalesce(len(w.befores), 0)
"""


SQL["op13_merkle_manifest"] = _manifest_sql()
