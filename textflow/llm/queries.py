"""The queries opN_<name>: each applies one operator with its production parameters to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.functions.text import rounded
from textflow.llm import importance, jaccard, langid, mixing, neardup, packing, periods, quality, secrets, substrings, topk, urls, warc


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: doc_id, n_shingles, component_id, kept."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents without repeated strings of 200 bytes: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = substrings.repeated_spans(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, distances (rounded) and verdicts of all documents."""
    found = quality.quality(_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return found.withColumns({c: rounded(F.col(c), 9) for c in ("char_distance", "word_distance")})


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those that aren't held out; a document without id is held out."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    found = langid.predict(docs, langid.train(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: numbers by kind, a digest of the base spans, and all spans."""
    found = secrets.scan(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary file of this environment."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens: a row for each piece, with its place."""
    return packing.pack(_table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary(), keep_ids=False).drop("ids")


#: The rules of op1: (host with path prefix, verdict).
URL_RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of all pages by URL_RULES."""
    return urls.judge(_table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


def op9_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back."""
    found = warc.round_trip(_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of each vector whose id is divisible by 100, among all."""
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.search(rows, rows.where("vec_id % 100 = 0"))


#: How often op7 uses a document at most.
MAX_REPEAT = 4.0


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of the documents' sources and how often each document is used, none over four times."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs, max_repeat=MAX_REPEAT).select("doc_id", "source", mixing.token_count(F.col("text")).alias("n_tokens"), rounded(F.col("weight"), 9).alias("weight"), "copies")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, one in ten of which is made periodic first: their number, the one with the greatest exponent, and
    digests of all runs and of the words that are left without repeats."""
    found = periods.periodic_runs(_table(spark, sf_dir, "documents", "doc_id", "text"), planted=True)
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2("words", 256).alias("collapsed_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One in twenty of all documents, drawn by their likeness to the benchmark's texts: weights, scores and ranks of all."""
    found = importance.resample(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark", "text"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by a similarity of 0.90 on three-word shingles."""
    return jaccard.jaccard_groups(_table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {
    "op11_periodic_runs": op11_periodic_runs,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_ngram_jaccard_join": op13_ngram_jaccard_join,
    "op7_temperature_mixing": op7_temperature_mixing,
    "op10_exact_topk": op10_exact_topk,
    "op1_url_filter": op1_url_filter,
    "op9_warc_zip": op9_warc_zip,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op4_secret_scan": op4_secret_scan,
    "op3_language_id": op3_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
}

ORACLE_SQL: dict[str, str] = {}



def _similar(size: int, percent: int) -> str:
    """reach: the documents that links of similar shingle sets reach from each; sizes: of the sets."""
    return rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
sh AS (
  SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {size} THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - {size - 2}), lambda i: array_to_string(words[i:i + {size - 1}], ' ')) END) AS s FROM docs),
sets AS (SELECT DISTINCT doc_id, s FROM sh),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common >= {percent} * (p.n + q.n - common)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
found AS (SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
  FROM docs d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id))
"""


ORACLE_SQL["op6_minhash_near_dedup"] = _similar(5, 75) + "SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM found"
ORACLE_SQL["op13_ngram_jaccard_join"] = _similar(3, 90) + "SELECT doc_id, n_shingles, component_id FROM found"

#: CRC-32 of a list of bytes: the value of a byte is made by eight shifts, that of a list by one lookup for each byte.
_CRC_SQL = """
powers AS (SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS p FROM range(256) AS r(i))"""

ORACLE_SQL["op12_importance_resampling"] = rf"""
WITH {_CRC_SQL.strip()},
texts AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', row_number() OVER (), text FROM benchmark),
w AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
f AS (SELECT side, id, unnest(flatten(list_transform([1, 2, 3], lambda n: list_transform(range(1, len(words) - n + 2), lambda i: array_to_string(words[i:i + n - 1], ' '))))) AS feature FROM w),
h AS (SELECT feature, hex(encode(feature)) AS x FROM (SELECT DISTINCT feature FROM f)),
b AS (SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))), lambda c, v: xor(c >> 8, p[1 + (xor(c, v) & 255)])), 4294967295) % {importance.BUCKETS} AS bucket FROM h, powers),
n AS (SELECT side, id, bucket, count(*) AS n FROM f JOIN b USING (feature) GROUP BY 1, 2, 3),
c AS (SELECT g.bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 't'), 0) AS t FROM range({importance.BUCKETS}) AS g(bucket) LEFT JOIN n ON n.bucket = g.bucket GROUP BY 1),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + {importance.BUCKETS} AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + {importance.BUCKETS} AS DOUBLE)))) AS BIGINT) AS g FROM c),
weights AS (SELECT id, sum(n) AS n_features, sum(n * g) AS weight FROM n JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (SELECT d.id AS doc_id, len(d.words) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
  CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{importance.SEED}:' || d.id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM w d LEFT JOIN weights x ON x.id = d.id WHERE d.side = 'd'),
ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank FROM scored s LEFT JOIN ranks USING (doc_id)
"""

_PARTS = r"""
parts AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
          regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages)"""

ORACLE_SQL["op1_url_filter"] = f"""
WITH {_PARTS},
rules(rule, verdict, rule_host, rule_path) AS (VALUES {", ".join(f"('{r}', '{v}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for r, v in URL_RULES)}),
fits AS (SELECT page_id, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, length(rule_host) DESC) AS k
         FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.k = 1
"""

ORACLE_SQL["op9_warc_zip"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

ORACLE_SQL["op10_exact_topk"] = """
WITH codes AS (SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS code FROM embeddings),
far AS (SELECT q.vec_id AS query_id, c.vec_id, hamming(q.code, c.code) AS distance FROM codes q JOIN codes c ON q.vec_id % 100 = 0),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank, vec_id, distance FROM far)
SELECT * FROM ranked WHERE rank <= 10
"""

_CLASSES = [r"[a-z]", r"[A-Z]", r"[^\x00-\x7F]", r"[0-9]", r"[\x20\x09-\x0D]", r"[.,;:'\"?!()-]"]
_MARKS = r"[\x21-\x7E]"


def _class_counts() -> str:
    """Code points of a text by class, as a list: letters, others above ASCII, digits, white space, sentence marks, other marks,
    controls."""
    n = [f"len(regexp_extract_all(t, '{c.replace(chr(39), chr(39) * 2)}'))" for c in _CLASSES]
    return f"[{', '.join(n)}, len(regexp_extract_all(t, '{_MARKS}')) - {n[0]} - {n[1]} - {n[3]} - {n[5]}, length(t) - len(regexp_extract_all(t, '{_MARKS}')) - {n[2]} - {n[4]}]"


_PART = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END"
_JS = f"{_PART.format('p', 'q')} + {_PART.format('q', 'p')}"

ORACLE_SQL["op8_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(regexp_split_to_array(translate(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.,;:''"?!-()', ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS folded,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, {_class_counts()} AS classes FROM d),
grams AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS g FROM w WHERE len(words) >= 5),
again AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
s AS (SELECT doc_id, lang, folded, classes, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words FROM w LEFT JOIN covered c USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s),
words AS (SELECT doc_id, lang, unnest(folded) AS word FROM b),
totals AS (SELECT lang, sum(len(folded)) AS total FROM b WHERE lang IS NOT NULL GROUP BY lang),
usual AS (SELECT name, word, n FROM (SELECT lang AS name, word, count(*) AS n FROM words WHERE lang IS NOT NULL GROUP BY 1, 2) JOIN totals ON lang = name WHERE n >= {quality.COMMON} * total),
kinds AS (SELECT lang AS name, k, sum(classes[k]) AS n FROM b, (SELECT unnest(range(1, 9)) AS k) WHERE lang IS NOT NULL GROUP BY 1, 2),
long AS (SELECT b.doc_id, b.lang, n_words, classes, t.lang AS name, CASE WHEN b.lang = t.lang THEN 1 ELSE 0 END AS mine, total - CASE WHEN b.lang = t.lang THEN len(folded) ELSE 0 END AS mass
  FROM b CROSS JOIN totals t WHERE n_words >= {quality.LEAST_WORDS} AND total - CASE WHEN b.lang = t.lang THEN len(folded) ELSE 0 END >= {quality.LEAST_MASS}),
own AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY 1, 2),
bins AS (SELECT l.doc_id, l.name, coalesce(o.n, 0) AS n, coalesce(o.n, 0) / n_words AS p, (u.n - mine * coalesce(o.n, 0)) / mass AS q FROM long l JOIN usual u USING (name) LEFT JOIN own o ON o.doc_id = l.doc_id AND o.word = u.word),
inner_ AS (SELECT doc_id, name, sum({_JS}) AS js, sum(n) AS n, sum(q) AS qs, count(*) AS size FROM bins GROUP BY 1, 2),
outer_ AS (SELECT l.doc_id, l.name, greatest(l.n_words - coalesce(i.n, 0), 0) / l.n_words AS p, greatest(0, 1 - coalesce(qs, 0)) AS q, coalesce(i.js, 0) AS js, (coalesce(i.size, 0) + 1) / (8 * l.n_words) AS noise FROM long l LEFT JOIN inner_ i USING (doc_id, name)),
d_word AS (SELECT doc_id, name, greatest(sqrt(greatest((js + {_JS}) / 2, 0)) - sqrt(noise), 0) AS far FROM outer_),
others AS (SELECT l.doc_id, l.name, k.k, l.classes[k.k] / list_sum(l.classes) AS p, k.n - mine * l.classes[k.k] AS n FROM long l JOIN kinds k USING (name)),
d_char AS (SELECT doc_id, name, sqrt(greatest(sum({_JS}) / 2, 0)) AS far FROM (SELECT doc_id, name, p, n / greatest(sum(n) OVER (PARTITION BY doc_id, name), 1) AS q FROM others) GROUP BY 1, 2),
best AS (SELECT doc_id, c.far AS char_distance, w.far AS word_distance, greatest(c.far - {quality.CHAR_LIMIT}, w.far - {quality.WORD_LIMIT}) AS excess FROM d_char c JOIN d_word w USING (doc_id, name)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY excess, name) = 1),
judged AS (SELECT b.*, char_distance, word_distance, CASE WHEN n_words < {quality.LEAST_WORDS} THEN 'short' WHEN excess <= 0 THEN 'near' WHEN b.doc_id IN (SELECT doc_id FROM long WHERE mine = 1) THEN 'far' ELSE 'no reference' END AS verdict FROM b LEFT JOIN best USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  round(char_distance, 9) AS char_distance, round(word_distance, 9) AS word_distance, NOT base_failed AND verdict <> 'far' AS kept, verdict FROM judged
"""


def _bisection(rounds: int) -> str:
    """r1 ... : each parts (low, high) into sections and takes the first that meets the limit; x, z and least at its end."""
    out = ["r0 AS (SELECT CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high)"]
    for i in range(1, rounds + 1):
        out.append(f"""g{i} AS (SELECT k, low + (high - low) * k / {mixing.SECTIONS} AS x FROM r{i - 1}, (SELECT unnest(range({mixing.SECTIONS + 1})) AS k)),
e{i} AS (SELECT k, x, sum(pow(share, x)) AS z, min(pow(share, x) / share) AS least, max(pow(share, x) / share) / min(pow(share, x) / share) <= {MAX_REPEAT} + 1e-12 AS ok FROM g{i}, src WHERE tokens > 0 GROUP BY k, x),
k{i} AS (SELECT coalesce(min(k) FILTER (WHERE ok), {mixing.SECTIONS}) AS k FROM e{i}),
r{i} AS (SELECT (SELECT x FROM e{i} WHERE e{i}.k = greatest(k{i}.k - 1, 0)) AS low, x AS high, x, z, least FROM k{i} JOIN e{i} USING (k))""")
    return ",\n".join(out)


_HASH = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"

ORACLE_SQL["op7_temperature_mixing"] = rf"""
WITH t AS (SELECT doc_id, source, coalesce('=' || source, '-') AS s, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n, {_HASH.format("coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')")} AS key FROM documents),
src AS (SELECT s, sum(n) AS tokens, sum(n) / (SELECT greatest(sum(n), 1) FROM t) AS share FROM t GROUP BY s),
{_bisection(mixing.ROUNDS)},
u AS (SELECT s, tokens, CASE WHEN tokens > 0 THEN pow(share, x) / z ELSE 0 END AS weight, CASE WHEN tokens > 0 THEN pow(share, x) / share / least ELSE 1 END AS uses FROM src, r{mixing.ROUNDS}),
e AS (SELECT *, CAST(floor(uses) AS BIGINT) AS epochs, floor((uses - floor(uses)) * tokens) AS rest FROM u),
p AS (SELECT t.*, weight, epochs, rest, {_HASH.format(f"'{mixing.SEED}|' || epochs || '|' || key")} AS place FROM t JOIN e USING (s)),
c AS (SELECT *, sum(n) OVER (PARTITION BY s ORDER BY place) AS upto FROM p)
SELECT doc_id, source, n AS n_tokens, round(weight, 9) AS weight, CAST(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS INT) AS copies FROM c
"""
