"""The operators against brute force on a small fixture with nulls, empty, long, tied and repeated rows and extra columns."""

import collections
import hashlib
import math
import re
import sys

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import (
    backoff, exact_copies, host_reputation, main_text, packing, quality_model, queries, rule_cascade, shingle_join, token_codes, transducer,
)
from saltmarsh.llm.encoding import crc, vocabulary_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"word{i % 37}x{i}" for i in range(120))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, signature string, row int"


def _texts():
    near = BASE.split()
    near[60] = "changed"
    far = BASE.split()
    far[20] = far[50] = far[80] = far[100] = "other"
    return [
        (5, BASE), (2, BASE), (2, BASE), (9, " ".join(near)), (11, " ".join(far)), (1, None), (3, ""), (4, " \n\t "), (6, "one two three"),
        (7, "One  two\nthree"), (8, "THE!! " * 40), (10, "the same line\n" * 30), (12, "a " * 3000 + BASE), (None, "no id here"),
        (13, "| a | b | c " * 20), (17, "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|><|endoftext|>'s é<|startoftext|>\u0301e"), (14, "It's <|endoftext|> Über ĳ 漢字 straße, 12345.\x1c x"), (15, BASE + " tail"), (16, "x" * 20000),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "src1", 0, "s", 1) for i, t in _texts()], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))


def test_token_codes(spark, docs, empty, library):
    found = token_codes.token_table(docs, vocabulary_path("word_bpe_49k.json"), segment_ids=500).collect()
    expected = collections.Counter()
    for i, text in _texts():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        expected[i, len(ids), crc(np.array(ids))] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == expected
    found.sort(key=lambda r: r.start)
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    assert [r.doc_id for r in found if r.doc_id is not None] == sorted(i for i, _ in _texts() if i is not None)
    assert token_codes.token_table(empty, vocabulary_path("word_bpe_49k.json")).count() == 0


def test_codes_give_random_access(spark, docs, tmp_path):
    ids = np.random.default_rng(1).integers(0, 2**32, 3000, dtype=np.uint32) >> np.random.default_rng(2).integers(0, 32, 3000).astype(np.uint32)
    codes = token_codes.Codes(token_codes.pack(ids))
    assert [codes[i] for i in range(0, 3000, 7)] == ids[::7].tolist()
    assert all(np.array_equal(codes.read(i, 400), ids[i:i + 400]) for i in range(0, 2600, 53))
    assert len(token_codes.Codes(token_codes.pack(np.zeros(0, np.uint32)))) == 0
    folder = str(tmp_path / "tokens")
    token_codes.write_tokens(docs, vocabulary_path("word_bpe_49k.json"), folder, segment_ids=300)
    rows = sorted(token_codes.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    every = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows])
    wanted = spark.range(0, len(every) + 5, 31).withColumnRenamed("id", "position")
    found = {r.position: r.token for r in token_codes.tokens_at(spark, folder, wanted).collect()}
    assert found == {i: int(every[i]) if i < len(every) else None for i in range(0, len(every) + 5, 31)}


def brute_components(rows):
    sets = []
    for i, text in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words_of(text)]
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))
    for _ in rows:
        for a, s in enumerate(sets):
            for b, t in enumerate(sets):
                if s and t and 100 * len(s & t) >= 75 * len(s | t):
                    root[a] = root[b] = min(root[a], root[b])
    ids = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[root[k]].append(i)
    return collections.Counter((i, len(s), min(ids[root[k]], default=i) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def test_shingle_join(docs, empty):
    found = shingle_join.near_copies(docs).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(_texts())
    assert shingle_join.near_copies(empty).count() == 0


def _nameless():
    """A null-id near copy of 5, a null-id bridge between 31 and 33, two null-id near copies of each other, one id on many texts."""
    near = BASE.split()
    near[60] = "changed"
    ends = [" ".join(f"{w}{i}" for i in range(100)) for w in ("left", "mid", "alone")]
    side = ends[0].split()
    bridge = side[:94] + [f"new{i}" for i in range(16)]
    far = bridge[12:] + [f"newer{i}" for i in range(12)]
    alone = ends[2].split()
    alone[50] = "changed"
    return [(5, BASE), (None, " ".join(near)), (31, " ".join(side)), (None, " ".join(bridge)), (33, " ".join(far)), (None, ends[2]), (None, " ".join(alone)),
            (None, None), (None, "")] + [(7, f"{k} " * 9 + ends[1]) for k in range(20)]


def test_null_ids_are_linked(spark):
    docs = spark.createDataFrame([(i, t, "en", "src1", 0, "s", k) for k, (i, t) in enumerate(_nameless())], SCHEMA)
    expected = brute_components(_nameless())
    assert (None, 116, 5) in expected and (33, 106, 31) in expected
    found = shingle_join.near_copies(docs).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == expected
    kept = shingle_join.drop_near_copies(docs).collect()
    assert sorted(str(r.doc_id) for r in kept if r.doc_id != 7) == ["31", "5", "None", "None", "None"]
    assert sorted(r.row for r in kept if r.doc_id is None)[1:] == [7, 8] and len([r for r in kept if r.doc_id == 7]) == 20


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for size in [*range(1, 40), 63, 64, 90, 127, 128, 200, 500, 1100]:
        for _ in range(20):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            gone = int(rng.integers(0, size // 4 + 1))
            more = int(rng.integers(0, size // 3 + 1))
            b = np.concatenate([a[gone:], rng.integers(0, 2**63, more, dtype=np.uint64)])
            late = np.sort(np.concatenate([a[::3], rng.integers(0, 2**63, 5, dtype=np.uint64)]))
            if 100 * (size - gone) >= 75 * (size + more):
                one, two = (set(shingle_join.signatures(np.sort(x), late).tolist()) for x in (a, b))
                assert one & two


def test_groups_in_pieces(monkeypatch):
    """Rows come out once each with the least name as leader, wherever batches end and however large a group is."""
    monkeypatch.setattr(shingle_join, "OPEN_ROWS", 4)
    rng = np.random.default_rng(5)
    for _ in range(200):
        rows = sorted((int(s), int(n)) for s, n in zip(rng.choice(4, 60, p=[.6, .2, .1, .1]), rng.integers(0, 40, 60)))
        cuts = [0, *sorted(rng.integers(0, 61, 6).tolist()), 60]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i:j]], pa.int64()) for k in (0, 1)], names=["signature", "name"])
                   for i, j in zip(cuts, cuts[1:])]
        found = [tuple(r.values()) for b in shingle_join._groups(iter(batches)) for r in b.to_pylist()]
        groups = {}
        for s, n in set(rows):
            groups.setdefault(s, set()).add(n)
        assert sorted(found) == sorted((s, n, min(g)) for s, g in groups.items() if len(g) > 1 for n in g)


def test_exact_copies(spark, docs, empty):
    found = exact_copies.label_copies(docs).collect()
    groups = collections.defaultdict(list)
    for i, text in _texts():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = digest[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == min((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in found) == len(groups) and len(found) == len(_texts())
    kept = exact_copies.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    assert exact_copies.label_copies(hot).where("text_sha256 = sha2('hot', 256)").select("keep_id", "group_size").distinct().collect() == [(0, 1000)]
    assert exact_copies.label_copies(empty).count() == 0 and exact_copies.drop_copies(empty).count() == 0


def test_packing(docs, empty, library):
    found = packing.packed_documents(docs, vocabulary_path("word_bpe_49k.json"), capacity=64).collect()
    used = collections.defaultdict(list)
    for r in found:
        used[r.sequence_id].append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in _texts())
    assert sum(r.length for r in found) == total and packing.packed_documents(empty, vocabulary_path("word_bpe_49k.json")).count() == 0


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(4)
    lengths = np.sort(rng.integers(1, 101, 400))[::-1]
    window, offset = packing.best_fit(lengths, 100)
    free = {}
    for n, w, at in zip(lengths.tolist(), window.tolist(), offset.tolist()):
        fits = [f for f in free.values() if f >= n]
        assert (100 - at) == (min(fits) if fits else 100) and free.get(w, 100) == 100 - at
        free[w] = 100 - at - n


def test_quality_rules(docs, empty):
    found = rule_cascade.judge(docs).collect()
    expected = collections.Counter()
    for i, text in _texts():
        w = words_of(text)
        seen = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        cover = {k + j for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for j in range(8)}
        lines = [x for x in (text or "").split("\n") if words_of(x)]
        failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
        expected[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover), failed] += 1
    assert collections.Counter(tuple(r)[:7] for r in found) == expected
    assert all(not r.kept for r in found if r.base_failed) and {r.doc_id for r in found if r.kept} == {2, 5, 9, 11, 15}
    assert {r.doc_id for r in rule_cascade.keep_good(docs).collect()} == {2, 5, 9, 11, 15}
    assert rule_cascade.judge(empty).count() == 0
    orders = [rule_cascade.RULES, rule_cascade.RULES[::-1]]
    assert len({tuple(sorted(str(r) for r in rule_cascade.judge(docs, rules).collect())) for rules in orders}) == 1


def test_quality_classifier(spark, docs, empty):
    rows = []
    for k in range(400):
        good = k % 4 != 0
        text = " ".join(f"plain{(k * 7 + j * 13) % 997}" + ("" if good else "***") for j in range(30 + k % 50))
        rows.append((k, text, "en" if k % 2 else None, None if k % 5 == 0 else f"src{k % 3}", good))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, truth boolean")
    labels = spark.createDataFrame([(k, int(g), 0) for k, _, _, _, g in rows if k % 3] + [(None, 1, 0), (9999, 0, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality_model.judge(table, labels).collect()}
    held_out = [k for k, *_ in rows if k % 3 == 0]
    assert len(found) == 400 and sum(found[k].kept == rows[k][4] for k in held_out) >= 0.97 * len(held_out)
    kept = quality_model.keep_good(table, labels)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {k for k, r in found.items() if r.kept}
    assert quality_model.judge(docs, labels.limit(0)).where("kept").count() == len(_texts())
    assert quality_model.judge(empty, labels).count() == 0


def test_sparse_sites_stay_near_the_prior(spark):
    docs = spark.createDataFrame([(k, "a" if k < 200 else "b" if k < 400 else "c", "en") for k in range(402)], "doc_id long, source string, lang string")
    labels = spark.createDataFrame([(k, int(k % 10 > 0) if k < 200 else int(k % 10 > 6) if k < 400 else 0) for k in range(401)], "doc_id long, quality int")
    found = {r.host: r.prior for r in quality_model.posteriors(docs, labels).collect()}
    assert abs(found["a"] - 0.9) < 0.05 and abs(found["b"] - 0.3) < 0.05 and 0.1 < found["c"] < 0.6


def test_backoff(docs, empty, library):
    found = backoff.score(docs, vocabulary_path("word_bpe_49k.json")).collect()
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in _texts()]
    pairs, tokens, contexts = collections.Counter(), collections.Counter(), collections.Counter()
    for v in ids:
        pairs.update(zip([-1, *v], v))
        tokens.update(v)
        contexts.update([-1, *v[:-1]] if v else [])
    expected = []
    for (i, _), v in zip(_texts(), ids):
        seen = [pairs[p] >= 2 for p in zip([-1, *v], v)]
        logs = [math.log(pairs[p] / contexts[p[0]]) if s else math.log(0.4 * tokens[p[1]] / tokens.total()) for s, p in zip(seen, zip([-1, *v], v))]
        expected.append((str(i), len(v), seen.count(False), round(sum(logs), 3) + 0.0))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_backed_off, round(r.log_prob, 3) + 0.0) for r in found) == sorted(expected)
    assert backoff.score(empty, vocabulary_path("word_bpe_49k.json")).count() == 0


def test_backoff_sends_counts_in_few_bytes(docs):
    """Before, each count and each n-gram took eight bytes of an Arrow batch, whatever their size."""
    path = vocabulary_path(queries.WORDS)
    size = backoff.encoder(path).library.get_vocab_size()
    found = backoff.gram_counts(backoff.texts(docs), path, size, 3, 4, 2).collect()
    for row in found:
        assert len(row["counts"]) <= 2 * len(backoff._unplanes(row["keys"])) + 1  # none is above 65535
    for numbers in ([], [0, 0], [1, 255], [256, 3], [2**64 - 1, 0]):
        x = np.array(numbers, np.uint64)
        assert backoff._unpacked(backoff._packed(x)).tolist() == numbers
        assert backoff._unplanes(backoff._planes(np.sort(x))).tolist() == sorted(numbers)


def test_backoff_encodes_each_text_once(docs, capsys):
    """Before, the scoring step encoded all texts again; now both steps read ids written once."""
    backoff.score(docs, vocabulary_path(queries.WORDS)).explain()
    assert "ids#" in (plan := capsys.readouterr().out) and "text#" not in plan


def test_backoff_deals_buckets_evenly(spark):
    """Before, the partition of a bucket was a hash of its number, so some had several buckets and others none."""
    rows = spark.createDataFrame([(b,) for b in range(20)], "bucket int")
    found = collections.Counter(r[0] for r in backoff._dealt(rows, 10).select(F.spark_partition_id()).collect())
    assert sorted(found.values()) == [2] * 10


def test_backoff_rows_stay_long():
    """Before, a slice was as long with 12,000 buckets as with 200, so the rows of both steps grew faster than the input."""
    assert [backoff._held(b) for b in (1, 512, 1 << 20)] == [backoff.LEAST_HELD, 512 * backoff.ROW_GRAMS, backoff.MOST_HELD]


@pytest.mark.parametrize("slice_grams", [1, 5, 1 << 18])
def test_backoff_grams_of_any_slice(monkeypatch, slice_grams):
    """Slices of stored ids, also of batches that do not start at their buffers' start, give the n-grams of whole texts."""
    monkeypatch.setattr(backoff, "SLICE_GRAMS", slice_grams)
    texts = [[3, 1, 2], [], [0], [4] * 9, [], [2, 3]]
    for size in (5, 1 << 17):
        whole = pa.RecordBatch.from_arrays([pa.array([np.array(t, backoff._id_type(size)).tobytes() for t in texts], pa.binary())], names=["ids"])
        for first in (0, 2):
            expected = [size * (size + 1) ** 2 + size * (size + 1) + t if k == 0 else (size if k == 1 else text[k - 2]) * (size + 1) ** 2 + text[k - 1] * (size + 1) + t
                        for text in texts[first:] for k, t in enumerate(text)]
            parts = list(backoff._grams(iter([whole.slice(first), whole.slice(6)]), size, 3))
            assert np.concatenate([k for k, _, _ in parts]).tolist() == expected
            assert np.concatenate([n for _, n, _ in parts]).tolist() == [len(t) for t in texts[first:]]
            assert sum(p.num_rows for _, _, p in parts) == 6 - first


@pytest.mark.parametrize("top", [50_000**3, 1 << 64])
def test_backoff_sorts_by_key_and_document(top):
    """Where both fit in one number and where they do not; buckets keep that order, counts are those of each key."""
    random = np.random.default_rng(3)
    keys, owner = random.integers(0, 300, 5000).astype(np.uint64) * np.uint64(50_000**3 // 300), random.integers(0, 1 << backoff.OWNER_BITS, 5000)
    found = list(zip(*(x.tolist() for x in backoff._by_key(keys, owner, top))))
    assert found == sorted(zip(keys.tolist(), owner.tolist()))
    for buckets in (1, 7, 1 << 17):
        places = [at for _, at in backoff._by_bucket(keys, buckets)]
        assert all((np.diff(at) > 0).all() for at in places) and sorted(np.concatenate(places).tolist()) == list(range(5000))
        assert sum(len(np.unique(keys[at])) for at in places) == len(np.unique(keys))
    assert dict(zip(*(x.tolist() for x in backoff._counted(keys)))) == collections.Counter(keys.tolist())


@pytest.mark.parametrize("heavy", [1, 1 << 21])
def test_backoff_counts_longer_contexts(spark, library, monkeypatch, tmp_path, heavy):
    """The registered query has triples, backing off to pairs and then to tokens, by either way of meeting the table."""
    monkeypatch.setattr(backoff, "HEAVY", heavy)
    extra = [(20, "red fox runs far"), (21, "red fox runs home"), (22, "grey fox runs off"), (23, "one fox runs far off")]
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in [*_texts(), *extra]], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.ENTRIES["op5_stupid_backoff"].run(spark, str(tmp_path)).collect()
    ids = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in [*_texts(), *extra]]
    grams, contexts = collections.Counter(), collections.Counter()
    for _, v in ids:
        padded = [-1, -1, *v]
        for k in range(2, len(padded)):
            for n in (1, 2, 3):
                grams[tuple(padded[k + 1 - n:k + 1])] += 1
                contexts[tuple(padded[k + 1 - n:k])] += 1

    def log_score(g):
        if len(g) == 1:
            return math.log(grams[g] / contexts[()])
        return math.log(grams[g] / contexts[g[:-1]]) if grams[g] >= 2 else math.log(0.4) + log_score(g[1:])

    expected = []
    for i, v in ids:
        all_grams = [tuple(([-1, -1, *v])[k:k + 3]) for k in range(len(v))]
        expected.append((str(i), len(v), sum(grams[g] < 2 for g in all_grams), round(sum(map(log_score, all_grams)), 3) + 0.0))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_backed_off, round(r.log_prob, 3) + 0.0) for r in found) == sorted(expected)


def test_url_reputation(spark):
    urls = ["http://A.example.org/es/1?x", "https://example.org/en/12#y", "http://x.com/de/", "http://x.com/en/1", "http://y.com/fr/a", "http://y.com/en",
            "http://Z.co.uk:80/a?b", None, "", "no scheme", "http://org/", "http://org", "http://notorg/fr/", "a://b://c/d"] + ["http://bad.com/de/1"] * 30 + ["http://bad.com/en/2"]
    pages = spark.createDataFrame([(k, u, "h", "r") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    found = {r.page_id: r for r in host_reputation.judge(pages, queries.URL_RULES).collect()}
    assert (found[0].host, found[0].path, found[0].rule, found[0].verdict) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert found[1].rule == "example.org/en/1" and found[10].rule == "org/" and found[11].rule is None and found[12].rule is None
    assert (found[7].host, found[7].path) == ("", "") == (found[9].host, found[9].path) and (found[13].host, found[13].path) == ("b:", "//c/d")
    assert found[44].rule is None and found[44].verdict == "block"
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(urls)))
    expected = sorted(map(str, con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({queries.URL_SQL})").fetchall()))
    assert sorted(str(tuple(r)) for r in found.values()) == expected
    assert host_reputation.judge(pages.limit(0), queries.URL_RULES).count() == 0


def test_site_levels(spark):
    frame = spark.createDataFrame([("a.b.example.co.uk:8080",), ("x.com",), ("localhost",), ("",)], "host string")
    domain, suffix = host_reputation.site_levels(F.col("host"))
    assert [tuple(r) for r in frame.select(domain, suffix).collect()] == [("example.co.uk", "co.uk"), ("x.com", "com"), ("localhost", "localhost"), ("", "")]


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><a href=/>Home</a></header>
<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav><div class="cookie-notice">We use cookies here.</div><div class="ad">Buy now</div>
<div id="content"><article><h1>Head &amp; line</h1><p><b>First <i>para</i>graph of the text,&nbsp;with words.<br><p>Second
 one.<!-- hidden --><aside>Related things</aside><table><tr><td>cell<td>next</table></article></div>
<form><input value=x>Sign up</form><section id="comments"><p>Nice article, thank you all for this.</section><footer>&copy; 2020</footer>"""


def test_main_text(spark):
    assert main_text.main_text(PAGE) == "Head & line First paragraph of the text, with words. Second one. cell next"
    plain = "<body><div class=menu><a>x</a></div><div><div><p>" + "Some longer words here. " * 9 + "</p><p>Short.</p></div></div><div class=footer>f</div>"
    assert main_text.main_text(plain) == ("Some longer words here. " * 9).strip() + " Short."
    assert main_text.main_text("") == "" == main_text.main_text("<nav>a</nav>") and main_text.main_text("<div>" * 5000 + "deep") == "deep"
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (2, None, "", None)], "page_id long, url string, html string, text string")
    assert sorted(r.n_chars for r in main_text.extract(pages).collect()) == [0, 0, 74]
    assert main_text.extract(pages.limit(0)).count() == 0


def test_byte_bpe(docs, empty):
    import public_tokenizers
    import tiktoken

    path = vocabulary_path("byte_bpe_multi_50k.tiktoken")
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=transducer.load_ranks(path), special_tokens={})
    expected = []
    for i, text in _texts():
        ids = reference.encode_ordinary(text or "")
        expected.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    found = transducer.round_trip(docs, path, public_tokenizers.PATTERN, chunk=3).collect()
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in found) == sorted(expected)
    back = transducer.decode(transducer.encode(docs, path, public_tokenizers.PATTERN), path, chunk=2)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(i), t or "") for i, t in _texts())
    assert transducer.round_trip(empty, path, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_worker_memory_is_bounded(monkeypatch):
    import public_tokenizers
    import tiktoken

    path = vocabulary_path("byte_bpe_multi_50k.tiktoken")
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=transducer.load_ranks(path), special_tokens={})
    random = np.random.default_rng(10)
    texts = [" ".join("".join(map(chr, random.integers(97, 123, random.integers(1, 9)))) for _ in range(40_000))]  # hardly a word twice
    texts += ["".join(map(chr, random.integers(0x4E00, 0x9FA5, 20_000))), "a \n b \n\nc  \nd   e's \n" * 50, texts[0]]  # one piece without an end, white space
    encoder = transducer.TextEncoder(path, public_tokenizers.PATTERN)
    found = [x.tolist() for x in encoder.encode(texts)]
    assert found == [reference.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(transducer, "STEPS", 5_000)
    monkeypatch.setattr(transducer, "MEMO_BYTES", 1 << 20)
    monkeypatch.setattr(transducer, "FITS", 1_000)
    small = transducer.TextEncoder(path, public_tokenizers.PATTERN)
    assert [x.tolist() for x in small.encode(texts)] == found
    assert len(small.transducer.steps) <= 5_000 and len(small.transducer.states) <= 5_001 and len(small.transducer.fit) <= 1_000
    held = [sys.getsizeof(k) + sys.getsizeof(v) for part in (small.memo.young, small.memo.old) for k, v in part.items()]
    assert sum(held) < 2 << 20 and len(small.memo.young) + len(small.memo.old) < 20_000


def test_stream_decoder_waits_for_whole_characters():
    token = {i: bytes([i]) for i in range(256)}
    stream, text, out = transducer.StreamDecoder(token), "aé漢🙂z".encode(), []
    for byte in text:
        out.append(stream.feed([byte]).decode())
    assert "".join(out) == text.decode() and stream.finish() == b""


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = [(k, f"{BASE} {' '.join(f'own{k}w{j}' for j in range(200))}", "en", "src1", 0) for k in range(20)]
    rows += [(100, rows[3][1], "en", "src1", 0), (101, rows[4][1].replace("own4w7 ", "edit "), "en", "src1", 0), (102, "### " * 50, "en", "src1", 0), (103, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, 0) for k in range(20)] + [(102, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} == set(range(20))


def test_sketches_never_hide_a_similar_pair():
    random = np.random.default_rng(5)
    for n in (1, 3, 30, 63, 64, 120, 128, 700, 1000):
        base = np.unique(random.integers(0, 1 << 63, n, dtype=np.uint64))
        for change in (0, n // 20, n // 8, n // 7):
            other = np.unique(np.concatenate([base[change:], random.integers(0, 1 << 63, change + n // 16, dtype=np.uint64)]))
            common = len(np.intersect1d(base, other))
            near = shingle_join.near_pairs(
                np.array([1, 2]), np.array([len(base), len(other)]), [shingle_join.sketch(base), shingle_join.sketch(other)])
            if shingle_join.similar(common, len(base), len(other)):
                assert len(near[0])
    far = [shingle_join.sketch(np.unique(random.integers(0, 1 << 63, 900, dtype=np.uint64))) for _ in range(20)]
    assert not len(shingle_join.near_pairs(np.arange(20), np.full(20, 900), far)[0])


def test_pieces_are_the_same_over_any_batches():
    random = np.random.default_rng(6)
    sets = [np.unique(random.integers(0, 1 << 63, 200, dtype=np.uint64)) for _ in range(6)]
    sets += [x[:-4] for x in sets[:3]]
    rows = [(task, k, k, len(sets[k]), shingle_join.sketch(sets[k])) for task in range(5) for k in range(9)]
    schema = pa.schema([("task", pa.int64()), ("name", pa.int64()), ("root", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())])
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    seen = []
    for size in (1, 7, 100):
        out = pa.Table.from_batches(list(shingle_join._near(iter(table.to_batches(max_chunksize=size)))))
        seen.append({tuple(r.values()) for r in out.to_pylist()})
        assert sorted({r[0] for r in seen[-1]}) == [0, 1, 2, 6, 7, 8] and len(seen[-1]) == 6
    assert seen[0] == seen[1] == seen[2]
