"""URL filters, archives, exact search, the pipeline, and what may import what."""

import hashlib
import os
import re
import subprocess
import sys
import zipfile
from io import BytesIO

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textflow.llm import topk, urls, warc
from textflow.llm.queries import ORACLE_SQL, QUERIES, URL_RULES

from .helpers import SCHEMA, awkward, prose

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DIR = "/root/testdata/sf0.001"


# -- URLs


def plain_judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        m = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
        host, path = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]
    best = None
    for rule, verdict in rules:
        h, slash, p = rule.partition("/")
        if h and (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            key = (len(rule), len(h), verdict == "block")
            best = max(best, (key, rule, verdict)) if best else (key, rule, verdict)
    return host, path, best and best[1], best[2] if best else "allow"


URLS = [
    "http://a.example.com/en/7x", "http://example.com/en/8", "https://EXAMPLE.com/en/", "http://xexample.com/en/7", "http://org/es/1", "https://a.b.org/de/", "http://n.example.net/de/8?x#y", "http://net/de/9", "ftp://com", "nourl", None, "",
    "http://u@com:80/en/", "x?y://com/en/1", "http://example.com", "http://example.com?/en/7", "http://.com/en/1", "http://a..com/en/", "http://com./en/", "://com/en/#", "http://ÉXAMPLE.com/en/7",
]


@pytest.mark.parametrize("most", [None, 100_000, 1])
def test_urls(spark, most):
    """A list of rules, a small table of them, and a table that is dealt out with the URLs."""
    rows = [*enumerate(URLS), (3, URLS[3]), (None, URLS[0])]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in rows], "page_id long, url string, rule string, host string").repartition(3)
    rules = URL_RULES if most is None else spark.createDataFrame(URL_RULES, "rule string, verdict string")
    got = sorted(urls.judge(df, rules, most=most or 10).collect(), key=str)
    assert sorted(((i, *plain_judge(u, URL_RULES)) for i, u in rows), key=str) == sorted(map(tuple, got), key=str)


@pytest.mark.parametrize("sampled", [1, 20])
def test_many_rules_are_dealt_out(spark, monkeypatch, sampled):
    """One sweep whatever the number of rules; a third of the URLs have one host, some rules hold for many ranges."""
    monkeypatch.setattr(urls, "SAMPLED", sampled)
    r = np.random.default_rng(sampled)
    names = [f"h{i}.{d}.{t}" for i in range(20) for d in ("a", "b", "shop") for t in ("com", "net", "org")] + ["com", "a.com", "shop.org", "net", "hot.com"]
    paths = ["", "/", "/x", "/x/y", "/é", "/xyz"]
    rules = list({names[i] + paths[j] + (str(k) if paths[j] else ""): "allow" if k % 2 else "block" for i, j, k in r.integers(0, [len(names), len(paths), 5], (400, 3))}.items())
    made = [f"http://{'www.' if k % 2 else ''}{names[i] if k % 3 else 'hot.com'}{paths[j] or '/'}{k}/z" for i, j, k in r.integers(0, [len(names), len(paths), 6], (600, 3))]
    rows = [*enumerate(made), (5, None), (6, "nourl"), (None, made[0])]
    pages, table = spark.createDataFrame(rows, "page_id long, url string").repartition(3), spark.createDataFrame([*rules, (None, "x"), ("a.com", None)], "rule string, verdict string")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        out = urls.judge(pages, table, most=10)
        got = sorted(map(tuple, out.collect()), key=str)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == sorted(((i, *plain_judge(u, rules)) for i, u in rows), key=str)
    assert plan.split("Initial Plan")[0].count("MapInArrow") == 1
    assert urls.judge(pages.limit(0), table, most=10).count() == 0


HOSTS = st.lists(st.sampled_from(["a", "b", "com", "A"]), min_size=1, max_size=4).map(".".join)
PATHS = st.text("/ab", max_size=4)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(HOSTS.map(str.lower), PATHS, st.sampled_from(["allow", "block"])), max_size=8), st.lists(st.tuples(HOSTS, PATHS), max_size=8))
def test_sweep(rules, pages):
    rules = [(h + ("/" + p if p else ""), v) for h, p, v in rules]
    sweep = urls.Sweep(rules)
    made = [(f"http://{h}/{p}") for h, p in pages]
    parts = sorted((urls.host_key(plain_judge(u, [])[0]), plain_judge(u, [])[1], u) for u in made)
    for key, path, u in parts:
        rule, verdict = sweep.judge(key, path)
        assert (rule, verdict or "allow") == plain_judge(u, rules)[2:]


def test_urls_without_rules_or_pages(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert urls.judge(df, []).first().verdict == "allow"
    assert urls.judge(df, spark.createDataFrame([("com", "block"), (None, "x")], "rule string, verdict string")).first().verdict == "block"
    assert urls.judge(df.limit(0), URL_RULES).count() == 0


# -- archives


def reader(data):
    return lambda at, n: data[at : at + n]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("ab/é.", min_size=1, max_size=8), st.binary(max_size=50), max_size=5), st.booleans(), st.binary(max_size=30).filter(lambda c: b"PK" not in c))
def test_zip_round_trip(members, wide, comment):
    data = warc.zip_bytes(list(members.items()), wide, comment)
    found = warc.zip_members(reader(data), len(data))
    assert {n: data[s : s + m.size] for n, m in found.items() for s in [warc.data_start(reader(data), m)]} == members
    with zipfile.ZipFile(BytesIO(data)) as z:  # another implementation agrees
        assert {n: z.read(n) for n in z.namelist()} == members


def test_zip_of_another_writer_and_broken_files():
    out = BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.comment = b"PK\5\6 in a comment" * 9
        z.writestr("a", b"1" * 99)
        with z.open("b", "w", force_zip64=True) as f:
            f.write(b"two")
        z.writestr("c", b"3" * 999, zipfile.ZIP_DEFLATED)
    data = out.getvalue()
    found = warc.zip_members(reader(data), len(data))
    assert data[(s := warc.data_start(reader(data), found["b"])) : s + found["b"].size] == b"two"
    with pytest.raises(ValueError, match="not stored"):
        warc.data_start(reader(data), found["c"])
    with pytest.raises(ValueError, match="no end"):
        warc.zip_members(reader(b"nothing"), 7)


PAGES = [(1, "http://a/", "<p>same</p>"), (5, "http://b/\n", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "u", None), (4, "u", ""), (6, "é", "ü" * 5000), (7, "u", "HTTP\r\n\r\nx\r\n\r\n"), (8, "u", "ü" * 5000), (8, "u", "ü" * 5000), (None, "u", "<p>same</p>"), (None, "u", "alone")]


@pytest.mark.parametrize(("wide", "size", "least"), [(False, 1 << 24, 0), (True, 300, 0), (True, 300, 12)])
def test_archives_round_trip(spark, wide, size, least):
    df = spark.createDataFrame([(*r, "x") for r in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload)) for r in warc.round_trip(df, least, size, wide).collect()), key=str)
    want = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        first = min((j for j, _, h in PAGES if (h or "") == (html or "") and j is not None), default=None)
        revisit = len(raw) >= least and i != first
        want.append((i, len(raw), warc.base32(hashlib.sha1(raw).hexdigest()), "revisit" if revisit else "response", first if revisit else None, None if revisit else raw))
    assert got == sorted(want, key=str)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_a_folder_is_one_place_with_and_without_a_scheme(spark, tmp_path):
    from textflow.llm._shared import qualified, shared_dir

    assert qualified(spark, str(tmp_path)) == qualified(spark, f"file:{tmp_path}") == f"file://{tmp_path}"
    assert shared_dir(spark).startswith("file:///")
    df = spark.createDataFrame([(1, "http://a.example/", "x")], "page_id long, url string, html string")
    for folder in (f"{tmp_path}/plain", f"file:{tmp_path}/one", f"file://{tmp_path}/two"):
        assert warc.read(warc.write(df, folder), folder).first().page_id == 1
    assert {x.name for x in tmp_path.iterdir()} == {"plain", "one", "two"}


def test_only_archives_of_the_manifest_are_read(spark, tmp_path):
    df = spark.createDataFrame(PAGES[:3], "page_id long, url string, html string")
    manifest = warc.write(df, str(tmp_path))
    (tmp_path / "left-behind.zip").write_bytes(b"half an archive")
    assert warc.read(manifest, str(tmp_path)).count() == 3


# -- search


def plain_search(rows, queries, k, bits):
    codes = {}
    for i, v in rows:
        if i is not None and v is not None:
            codes.setdefault(i, set()).add("".join("1" if j < len(v) and v[j] is not None and v[j] > 0 else "0" for j in range(bits)))
    out = set()
    for i, v in queries:
        if i is None or v is None:
            continue
        q = "".join("1" if j < len(v) and v[j] is not None and v[j] > 0 else "0" for j in range(bits))
        far = sorted({(sum(a != b for a, b in zip(q, c, strict=True)), j) for j, cs in codes.items() for c in cs})[:k]
        out |= {(i, r, j, d) for r, (d, j) in enumerate(far, 1)}
    return out


@pytest.mark.parametrize(("shard", "block", "k"), [(1 << 18, 1 << 15, 10), (50, 3, 10), (7, 100, 3)])
def test_search_is_exact(spark, shard, block, k):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 64))
    rows = [(i, [float(x) for x in centre[i % 12] + rng.normal(size=64) * 0.7]) for i in range(400)] + [(1000 + i, [1.0] * 64) for i in range(60)]
    rows += [(2000, None), (None, [1.0] * 64), (2001, [1.0]), (2002, [None, 1.0]), (2003, [float("nan")] * 64), (5, rows[5][1])]
    rows = [(i, v) for i, v in rows if i != 2003]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(4)
    asked = df.where("vec_id % 50 = 0 or vec_id > 1990")
    got = {tuple(r) for r in topk.search(df, asked, k, shard=shard, block=block).collect()}
    assert got == plain_search(rows, [(i, v) for i, v in rows if i is not None and (i % 50 == 0 or i > 1990)], k, 64)


def test_search_of_few_and_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0] * 64), (2, [-1.0] * 64)], "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.search(df, df.where("vec_id = 1")).collect()} == {(1, 1, 1, 0), (1, 2, 2, 64)}
    assert topk.search(df.limit(0), df).count() == 0 and topk.search(df, df.limit(0)).count() == 0


# -- queries and pipeline


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want, got = c.sql(ORACLE_SQL[name]).df(), QUERIES[name](spark, DIR).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols

    def rows(df):
        df = df[cols].astype(object)
        plain = df.where(df.notna(), None).map(lambda x: int(x) if isinstance(x, float) and x == int(x) else x)
        return sorted(str(list(r)) for r in plain.itertuples(index=False))

    assert rows(want) == rows(got)


def test_vectors_of_more_and_of_different_dimensions(spark):
    """No dimension is cut; what a shorter vector lacks isn't positive."""
    one = [1.0] * 128
    rows = [(1, one), (2, [1.0] * 64 + [-1.0] * 64), (3, [1.0] * 100), (4, [1.0, None, float("nan")] * 30), (5, []), (6, one)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    bits = {i: [bool(j < len(v) and v[j] is not None and (v[j] > 0 or v[j] != v[j])) for j in range(128)] for i, v in rows}
    got = {(r.query_id, r.vec_id): r.distance for r in topk.search(df, df, 10).collect()}
    assert got == {(a, b): sum(x != y for x, y in zip(bits[a], bits[b], strict=True)) for a in bits for b in bits}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P

    from textflow.llm import quality, secrets
    from textflow.llm.queries import vocabulary
    from tokenizers import Tokenizer

    from .test_documents import plain_components

    rows = awkward() + [(100 + i, prose(300 + i, 90), "en", "ab"[i % 3 == 0], 1, 1) for i in range(60)] + [(200, f'{prose(400, 60)} token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" {prose(401, 30)}', "en", "a", 1, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).persist()
        assert docs.columns == df.columns, name
        kept.append([tuple(r) for r in docs.collect()])
    verdict = {r.doc_id: r.kept for r in quality.quality(df).collect()}
    assert sorted(map(str, kept[0])) == sorted(str(r) for r in rows if verdict[r[0]])
    groups = plain_components([(r[0], r[1]) for r in kept[0]])
    assert sorted(str(r[0]) for r in kept[1]) == sorted(str(i) for i, _, _, keep in groups if keep)
    assert "token" not in next(r for r in kept[2] if r[0] == 200)[1] and all(r[4] == len(r[1]) for r in kept[2])
    assert [x[1] for x in sorted(kept[2], key=str) if x[0] == 101] == [secrets.redacted(prose(301, 90), [])]
    assert {r[0] for r in kept[3]} == {r[0] for r in kept[2]} and len(kept[2]) <= len(kept[3]) <= 2 * len(kept[2])
    packed = P.run(spark, str(tmp_path)).collect()
    ids = Tokenizer.from_file(vocabulary())
    assert sum(r.length for r in packed) == sum(len(ids.encode(r[1], add_special_tokens=False).ids) + 1 for r in kept[3])


def test_nothing_else_imports_this_package():
    for folder, _, files in os.walk(os.path.join(ROOT, "textflow")):
        if os.path.basename(folder) == "llm":
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    assert "textflow.llm" not in f.read(), name


def test_the_rest_works_without_it(tmp_path):
    import shutil

    shutil.copytree(os.path.join(ROOT, "textflow"), tmp_path / "textflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'retrieval_dense_recall' in q and not any(n.startswith('op') and n[2].isdigit() for n in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})
