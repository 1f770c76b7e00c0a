"""Operators against brute force, round trips and planted cases, on small fixtures with nulls, blanks, ties and repeats."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parlance.llm import common, decontaminate, lm_score, mixing, multiset_hash, secrets, signature_tree, tokens, toxicity, url_filter, warc
from parlance.llm.common import Tables, components, new_path

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string, score double"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 0.5) for i, t in texts], DOC)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


EDGE = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "one two"), (905, "one two"), (906, "x" * 30_000)]


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize(("k", "percent", "hot"), [(3, 90, 64), (5, 80, 3)])
def test_jaccard_join(spark, k, percent, hot):
    rng = random.Random(k)
    texts = list(EDGE)
    for group in range(8):
        base = words(rng, rng.randint(20, 120)).split()
        for _ in range(rng.choice([1, 3, 12, 45])):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = words(rng, 1)
            texts.append((len(texts), " ".join(w)))
    passage = words(rng, 60)
    texts += [(len(texts) + i, f"{passage} {words(rng, rng.randint(1, 60))}") for i in range(60)]
    texts += [(len(texts) + i, f"{words(rng, 3)} {long}") for i, long in enumerate([words(rng, 1500)] * 3 + [f"{passage} {words(rng, 1450)}" for _ in range(6)])]
    join = signature_tree.JaccardJoin(k, f"{percent / 100}", hot_count=hot, block=16, covered=8)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join.run(table(spark, texts)).collect()}
    sets = {i: shingle_set(t, k) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}


def test_jaccard_join_repeats_nulls_and_empty_table(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "alone with no id and no copy"), (3, "x y z u v w"), (1, "x y z u v w"), (4, None), (None, "")]
    got = signature_tree.near_duplicates(table(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 0, 0), (0, 2, 1), (0, 3, 0), (1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4)]
    assert signature_tree.near_duplicates(table(spark, [])).count() == 0
    assert {r.component_id for r in signature_tree.near_duplicates(table(spark, [(1, "a b c"), (2, "a b c"), (3, "a b d")]), 3, "1.0").collect()} == {1, 3}


def test_jaccard_join_of_a_large_group_of_near_copies(spark):
    """5000 copies with a few words changed each: one class, and the tasks' pairs stay in proportion."""
    rng = random.Random(11)
    base = words(rng, 200).split()
    texts = []
    for i in range(5000):
        w = list(base)
        for _ in range(i % 4):
            w[rng.randrange(200)] = words(rng, 1)
        texts.append((i, " ".join(w)))
    far = [(6000 + i, " ".join([*words(rng, 60).split(), *base[60:]])) for i in range(50)]
    got = {r.doc_id: r.component_id for r in signature_tree.JaccardJoin(5, "0.8").run(table(spark, texts + far)).collect()}
    sets = {i: shingle_set(t, 5) for i, t in texts + far}
    near = lambda a, b: 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    assert all(near(i, 0) for i, _ in texts) and not any(near(i, j) for i, _ in far for j in sets if i != j)
    assert got == {i: 0 for i, _ in texts} | {i: i for i, _ in far}


@pytest.mark.parametrize("few", [False, True])
def test_trees_lose_no_similar_pair(few):
    """Nodes of one and of two blocks, sets of all bitmap sizes, members of one component: against all pairs."""
    rng = np.random.default_rng(18)
    rows, sets = [], {}
    for head in range(40):
        blocks = (0, 0) if head % 3 else (1, 2)
        base = rng.integers(0, 1 << 62, int(rng.choice([30, 400, 530, 1000, 4000])))
        for _ in range(rng.integers(1, 40)):
            kept = base[rng.random(len(base)) < rng.choice([0.99, 0.95, 0.9, 0.8])] if rng.random() < 0.8 else base[:0]
            s = np.unique(np.concatenate([kept, rng.integers(0, 1 << 62, int(len(base) * rng.choice([0, 0.05, 0.2])) + 3)])).astype(np.uint64)
            i = len(sets)
            sets[i] = s
            block = int(rng.choice(blocks))
            rows.append((head, 5, *blocks, block, bool(rng.random() < 0.7), i, i if rng.random() < 0.5 else head * 1000, len(s), signature_tree.bitmap(s)))
    names = ["head", "band", "i", "j", "block", "own", "id", "component", "n", "bits"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[lo : lo + 50]]) for lo in range(0, len(rows), 50)]
    found = {(r["a"], r["b"]) for b in signature_tree.candidate_batches(iter(batches), 90, few) for r in b.to_pylist()}
    every = [(x[6], y[6]) for x in rows for y in rows if x[0] == y[0] and x[6] < y[6] and x[7] != y[7] and (x[5] or y[5]) and (x[2] == x[3] or x[4] != y[4])]
    near = {(a, b) for a, b in every if 100 * len(np.intersect1d(sets[a], sets[b])) >= 90 * len(np.union1d(sets[a], sets[b]))}
    assert len(near) > 100 and found <= set(every)
    if few:
        reached = {x for pair in found for x in pair}
        assert {x for pair in near for x in pair} <= reached and len(found) <= 2 * len(rows)
    else:
        assert near <= found and len(found) < len(every) / 2


@pytest.mark.parametrize("last", [0, 1 << 14])
def test_components_of_chains_and_stars(spark, monkeypatch, last):
    monkeypatch.setattr(common, "LAST_EDGES", last)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint"), Tables(spark)).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_token_files(spark):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    parts = [" ", "\n", "a", "Bc", "é", "1", ".", ",", "\t", "'s", "  ", "\xa0", "中", "\r\n", "<|endoftext|>", "\0", "😀", " the", " x.", "word"]
    texts = [*EDGE, *((i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(300)), (None, "no id"), (7, "again"), (7, "again"), (8, "%%% &&& a%%% b.&&& c's! d''. ok"), (9, words(rng, 30_000))]
    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    root = new_path(spark, "test-tokens")
    files = tokens.write_tokens(table(spark, texts), root, tokens.tokenizer_path(), end=2, length=64, ranges=3, tokens=700)
    got = sorted(map(tuple, tokens.read_tokens(files, root).collect()), key=lambda r: r[1])
    start, expected = 0, []
    for i, t in sorted(((i, t or "") for i, t in texts), key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]), r[1].encode())):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expected
    file = files.first()["file"]
    ids, mask = tokens.SequenceFile(root, file).sequence(1)
    assert len(ids) == len(mask) == 64 and not ids.flags.owndata and files.count() > 6
    empty = new_path(spark, "test-tokens")
    assert tokens.read_tokens(tokens.write_tokens(table(spark, []), empty, tokens.tokenizer_path()), empty).count() == 0


def test_multiset_hash(spark):
    a, b = "x y z w\nsecond line of text\nthird", "third\nx y z w\nsecond line of text"
    fa = multiset_hash.fingerprint(a)
    assert (fa == multiset_hash.fingerprint(b)).all()
    more = multiset_hash.inserted(fa, "new one")
    assert (more == multiset_hash.fingerprint(a + "\nnew one")).all() and (multiset_hash.deleted(more, "new one") == fa).all()
    assert (multiset_hash.decoded(multiset_hash.encoded(fa)) == fa).all()
    rng = random.Random(2)
    texts = [*EDGE, *((i, words(rng, 200)) for i in range(40)), (40, words(rng, 3)), (None, "no id")]
    got = {r.doc_id: r for r in multiset_hash.fingerprints_with_edits(table(spark, texts)).collect()}
    rows = sorted(((i, t or "") for i, t in texts), key=lambda r: -(r[0] if r[0] is not None else -1))
    import hashlib

    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(t) // 3
        edited = t[: len(t) - cut] + u[:cut]
        assert (got[i].n_chars, got[i].edited_sha256, got[i].fingerprint) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), multiset_hash.encoded(multiset_hash.fingerprint(t)))
    assert all(got[i].near_edited > 0.45 > 0.3 > got[i].near_next for i in range(1, 39))
    one = multiset_hash.fingerprints_with_edits(table(spark, [(1, "a b c d e f")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert multiset_hash.fingerprints_with_edits(table(spark, [])).count() == 0


NAMES = ["ordinary", "identifier_name", "theword", "somethinglonger", "textofwords", "camelCaseName", "path/to/the-file", "HTTPServer", "request_handler", "maximumNumberOfRows"]


def labelled_tokens(spark, rng, n=60):
    mixed, lower, upper = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    random_ = ["".join(rng.choice(of) for _ in range(40)) for of in (mixed, lower, upper) for _ in range(n)]
    return [(t, True) for t in random_] + [(w, False) for w in NAMES * 20]


def chain_ratio(samples):
    """The mean log-likelihood ratio by plain Python."""
    chars, model = secrets.CHARS, {}
    for kind in (True, False):
        of = defaultdict(int)
        for t, secret in samples:
            if secret is kind:
                for a, b in zip(t, t[1:]):
                    of[a, b] += 1
        total = sum(of.values())
        share = {b: (sum(of[a, b] for a in chars) + 1) / (total + 68) for b in chars}
        out = {a: sum(of[a, b] for b in chars) for a in chars}
        model[kind] = {(a, b): (of[a, b] + 20 * share[b]) / (out[a] + 20) for a in chars for b in chars}
    return lambda text: sum(np.log(model[True][p] / (0.8 * model[False][p] + 0.2 * (p[0] == p[1]))) for p in zip(text, text[1:])) / (len(text) - 1)


def expected_spans(text, ratio):
    base = [(m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(secrets.BASE) for m in re.finditer(p.replace("{16,}", "+").replace("{24,}", "+"), text) if len(m[g]) >= least]
    covered = bytearray(len(text))
    for start, _, end in base:
        covered[start:end] = b"\1" * (end - start)
    free = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        low = m.start()
        for i in range(m.start(), m.end() + 1):
            if i == m.end() or covered[i]:
                if i - low >= 20 and ratio(text[low:i]) >= secrets.LEAST_RATIO:
                    free.append((low, 3, i))
                low = i + 1
    return sorted(base), sorted(base + free)


def test_likeness_is_near_the_share_of_common_shingles():
    rng = random.Random(15)
    for _ in range(40):
        lines = [words(rng, 8) for _ in range(rng.randint(5, 60))]
        other = [x if rng.random() < 0.6 else words(rng, 8) for x in lines]
        rng.shuffle(other)
        count = lambda of: Counter(tuple(x.split()[i : i + 3]) for x in of for i in range(6))
        a, b = count(lines), count(other)
        share = 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values()))
        x, y = (multiset_hash.fingerprint("\n".join(of)) for of in (lines, other))
        assert abs(multiset_hash.likeness(x, y) - share) < 0.25
        whole = multiset_hash.fingerprint("")
        for line in lines:
            whole = multiset_hash.inserted(whole, line)
        assert (whole == x).all()
        digests = [np.frombuffer(hashlib.blake2b(line.encode(), digest_size=2 * multiset_hash.EXACT).digest(), "<u2") for line in lines]
        assert [sum(int(d[i]) for d in digests) % (1 << 16) for i in range(multiset_hash.EXACT)] == x[: multiset_hash.EXACT].tolist()


def test_multiset_hash_of_repeats_nulls_and_long_texts(spark):
    rng = random.Random(16)
    long = words(rng, 60_000)
    got = multiset_hash.fingerprints_with_edits(table(spark, [(1, "a b c"), (1, "a b c"), (1, "z"), (None, None), (None, ""), (2, long), (3, long)]).withColumn("key", F.lit(1)).withColumn("part", F.lit(1))).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == sorted([(0, 0), (0, 0), (1, 1), (1, 5), (1, 5), (2, len(long)), (3, len(long))])
    of = {(r.doc_id, r.n_chars): r for r in got}
    assert of[3, len(long)].fingerprint == of[2, len(long)].fingerprint and of[3, len(long)].near_next == 1.0


def test_secrets(spark):
    key = "aB3dE5fG7hJ9kL1mN3pQ5rS7tU9"
    text = f'é😀 Token = "{"0a1b2c3d4e5f" * 3}" token=abc api_key: xyz PASSWORD:longenough AKIA{"A1B2" * 5} AKIAX {"ab" * 12} loose {key} thewordsofordinarytext {key}{"0f9e" * 9}'
    samples = labelled_tokens(spark, random.Random(1))
    df = spark.createDataFrame([*samples, (None, True), ("abc", None)], "token string, secret boolean")
    rows = [(1, text), (1, text), (None, text), (2, "-" * 60 + " " + "=" * 30 + " tttttttttttttttttttttttt"), *EDGE]
    found = secrets.scan(table(spark, rows), df).collect()
    base, spans = expected_spans(text, chain_ratio(samples))
    for r in found:
        if r.doc_id in (1, None):
            assert [(s.start, s.number, s.end) for s in r.base] == base and [(s.start, s.number, s.end) for s in r.spans] == spans
            assert all(text[s.start : s.end] == s.part for s in r.spans if s.kind == "random") and key in [s.part for s in r.spans]
        else:
            assert not r.spans
    assert len(found) == len(rows) and secrets.scan(table(spark, [])).count() == 0


def test_secrets_precision_and_recall(spark):
    """Held-out random strings and identifiers, models of the default samples."""
    rng = random.Random(12)
    secret = [t for t, s in labelled_tokens(spark, rng, 100) if s]
    secret = [t[: rng.randint(20, 40)] for t in secret]
    plain = ["".join(rng.choice(NAMES + ["value", "Count", "_list", "parser", "Index"]) for _ in range(5))[:40] for _ in range(300)]
    ordinary = [(i, " ".join(rng.choice(NAMES) for _ in range(60))) for i in range(40)]
    docs = table(spark, ordinary + [(1000 + i, f"see {t} here") for i, t in enumerate(secret)] + [(5000 + i, f"see {t} here") for i, t in enumerate(plain)])
    got = {r.doc_id for r in secrets.scan(docs).collect() if r.spans}
    caught = len([i for i in got if 1000 <= i < 5000])
    assert caught >= 0.97 * len(secret) and caught >= 0.97 * len(got)


def test_secrets_in_long_texts(spark):
    """One run of 200,000 characters, and thousands of matches of all kinds, against brute force."""
    rng = random.Random(4)
    run = lambda n, of="ABCxyz0189+/_": "".join(rng.choice(of) for _ in range(n))
    lines = [rng.choice([run(40), run(30, "0123456789abcdef"), f"token={run(9)}", f"😀 AKIA{run(16, 'AB12')}", "ordinary words", f"{run(26, 'abcdef')}{run(20)}"]) for _ in range(4000)]
    texts = [(1, run(200_000)), (2, "\n".join(lines)), (3, "-" * 50_000)]
    samples = labelled_tokens(spark, rng)
    found = {r.doc_id: r for r in secrets.scan(table(spark, texts), spark.createDataFrame(samples, "token string, secret boolean")).collect()}
    ratio = chain_ratio(samples)
    for doc_id, text in texts:
        base, spans = expected_spans(text, ratio)
        assert [(s.start, s.number, s.end) for s in found[doc_id].base] == base
        assert [(s.start, s.number, s.end) for s in found[doc_id].spans] == spans
    assert len(found[2].base) > 1000 and len(found[2].spans) > len(found[2].base)


def test_warc_round_trip_and_pushdown(spark):
    warc.register(spark)
    pages = [(3, "http://a/", "<p>é</p>"), (1, "http://b/\r\nx", "<p>é</p>"), (2, None, None), (5, "u", ""), (7, "u", "y" * 300_000)]
    root = new_path(spark, "test-warc")
    pages += [(3, "http://a/", "<p>é</p>"), (None, "http://n/", "none"), (None, None, "none")]
    kind = "page_id bigint, url string, html string"
    warc.page_records(spark.createDataFrame(pages, kind).withColumn("payload", F.lit(1)).withColumn("digest", F.lit(1))).write.format("warc").mode("append").option("fileBytes", 300).save(root)
    back = spark.read.format("warc").option("path", root).load()
    every = back.collect()
    got = {r.record_id: r for r in every}
    assert len(every) == len(pages) and sum(r.record_id is None and r.record_type == "response" and r.payload == b"none" for r in every) == 2 and sum(r.record_id == "<urn:page:3>" for r in every) == 2
    empty = new_path(spark, "test-warc")
    warc.page_records(spark.createDataFrame([], kind)).write.format("warc").mode("append").save(empty)
    assert spark.read.format("warc").option("path", empty).load().count() == 0
    assert got["<urn:page:3>"].record_type == "revisit" and got["<urn:page:3>"].refers_to == "<urn:page:1>" and got["<urn:page:5>"].refers_to == "<urn:page:2>"
    assert got["<urn:page:1>"].payload.decode() == "<p>é</p>" and got["<urn:page:7>"].payload_bytes == 300_000 == len(got["<urn:page:7>"].payload)
    import base64
    import hashlib

    assert got["<urn:page:3>"].payload_digest == "sha1:" + base64.b32encode(hashlib.sha1("<p>é</p>".encode()).digest()).decode()
    assert {r.record_id for r in back.where("record_type = 'revisit'").collect()} == {"<urn:page:3>", "<urn:page:5>"}
    assert spark.read.format("warc").option("path", root).option("payload", "false").load().where("payload is not null").count() == 0
    rows = [dict.fromkeys(warc.FIELDS) | {"record_id": f"<r{i}>", "record_type": "response", "payload": p, "payload_bytes": len(p)} for i, p in enumerate([b"abc", b"", b"z" * 9000])]
    import gzip
    import io

    for zipped, data in ((False, b"".join(map(warc.record_bytes, rows))), (True, b"".join(gzip.compress(warc.record_bytes(r)) for r in rows))):
        got = list(warc.records(io.BytesIO(data), len(data), zipped, {}, True))
        assert [(r[0], r[-1]) for r in got] == [(r["record_id"], r["payload"]) for r in rows]
        assert [r[0] for r in warc.records(io.BytesIO(data), len(data), zipped, {"record_id": {"<r2>"}}, False)] == ["<r2>"]
        if not zipped:
            for cut in (10, len(data) - 9000, len(data) - 200):
                with pytest.raises(ValueError, match="ends inside"):
                    list(warc.records(io.BytesIO(data[:cut]), cut, zipped, {}, True))
    foreign = b"WARC/1.0\r\nwarc-type:response\r\nno field\r\nContent-Type: application/http\r\ncontent-length:  6\r\n\r\nabcdef\r\n\r\n\r\n\r\n"
    assert [(r[1], r[-1]) for r in warc.records(io.BytesIO(foreign), len(foreign), False, {}, True)] == [("response", b"abcdef")]
    with pytest.raises(ValueError, match="no length"):
        list(warc.records(io.BytesIO(foreign.replace(b"content-length:  6", b"x:y")), len(foreign), False, {}, True))


def test_url_filter(spark):
    link = lambda *hosts: "".join(f'<a href="https://{h}/x">' for h in hosts)
    pages = [(1, "http://a.org/fr/1", link("good.com")), (2, "http://good.com/en", link("fine.com")), (3, "http://spam.com/", link("bad.net", "bad.net")), (4, "http://BAD.net/x", link("bad.net")), (5, "http://bad.net", None), (6, None, None), (7, "nothing", ""), (8, "http://x.example.net/en/?q", ""), (9, "http://x.example.net/en", ""), (10, "http://example.com/de/1", ""), (11, "http://fine.com/", link("spam.com", "good.com"))]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge(df).collect()}
    assert got[4] == ("bad.net", "/x", "net/", "block") and got[5][2:] == (None, "block") and got[6] == ("", "", None, "allow") == got[7]
    assert got[8][2:] == ("example.net/en/", "allow") and got[9][2:] == ("net/", "block") and got[10][3] == "block" and got[1][2] == "org/fr/"
    assert got[3][3] == "block" and got[2][3] == got[11][3] == "allow"
    assert url_filter.judge(df.where("false")).count() == 0


def test_propagation_over_links(spark):
    """A graph with cycles, a blocked host that very many link to and repeated pages, against brute force and against the query's SQL."""
    import duckdb

    rng = random.Random(9)
    names = [f"h{i}.com" for i in range(30)] + ["bad.net", "hub.net", "good.org", "x.example.net"]
    pages = [(i, f"http://{rng.choice(names[:30])}/p", "".join(f'<a href="//{h}/">' for h in rng.choices(names, k=rng.randint(0, 4)))) for i in range(90)]
    pages += [(100 + i, f"https://spam{i}.com/", '<A HREF="http://hub.net/x">' * 2) for i in range(1000)] + [(2000 + i, f"https://half{i}.com/", '<a href=//hub.net/><a href=//good.org/><a href=//fine.com/>') for i in range(5)]
    pages += [(4000 + i, f"http://chain{i}.com/", f'<a href="//{"bad.net" if not i else f"chain{i - 1}.com"}/x">') for i in range(12)] + [pages[0], (None, None, None), (3000, "http://spam3.com", None)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = sorted(map(tuple, url_filter.judge(df).select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    edges = defaultdict(float)
    for _, url, html in pages:
        source = (url or "").partition("://")[2].partition("/")[0]
        for h in re.findall("//([^/]*)", html or ""):
            if h != source:
                edges[source, h] += 1
    out = defaultdict(float)
    for (a, _), w in edges.items():
        out[a] += w
    hosts = {h for e in edges for h in e}
    start = {"trust": {h: float(h.endswith(".org")) for h in hosts}, "distrust": {h: float(h.endswith(".net")) for h in hosts}}
    score = {k: dict(v) for k, v in start.items()}
    for _ in range(300):
        now = {k: dict(v) for k, v in start.items()}
        for (a, b), w in edges.items():
            now["trust"][b] += 0.85 * score["trust"][a] * w / out[a]
            now["distrust"][a] += 0.85 * score["distrust"][b] * w / out[a]
        score = now
    blocked = {h for h in hosts if score["distrust"][h] >= url_filter.THRESHOLD and score["distrust"][h] > score["trust"][h]}
    assert {f"spam{i}.com" for i in range(1000)} <= blocked and {f"chain{i}.com" for i in range(5)} <= blocked and not {"half1.com", "chain6.com", "h1.com"} & blocked
    for _, host, _, rule, verdict in got:
        assert verdict == ("block" if rule == "net/" or rule is None and host in blocked else "allow"), host
    con = duckdb.connect()
    con.register("pages", df.toPandas().astype({"page_id": "Int64"}))
    found = con.sql(url_filter.OP9_SQL)
    order = [found.columns.index(c) for c in ("page_id", "host", "path", "rule", "verdict")]
    assert sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr) == got


def best_windows(texts, items, k=5):
    """The best similarity of all windows of each text to each item, by plain Python."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    kept = [(i, w, min(k, len(w))) for i, w in ((i, split(t)) for i, t in items) if w]
    shingled = lambda w, k: [tuple(w[j : j + k]) for j in range(len(w) - k + 1)]
    having = defaultdict(int)
    for _, w, size in kept:
        for x in set(shingled(w, size)):
            having[x] += 1
    weight = lambda x: np.log(1 + len(kept) / max(1, having[x]))
    out = {}
    for doc, text in texts:
        w = split(text)
        for item, of, size in kept:
            n, every, mine = len(of), shingled(w, size), set(shingled(of, size))
            if not mine & set(every):
                continue
            for start in range(max(0, len(w) - n) + 1):
                window = set(every[start : start + max(1, n - size + 1)])
                similarity = sum(map(weight, window & mine)) / sum(map(weight, window | mine))
                if similarity > out.get((doc, item), (0, 0))[0] + 1e-9:
                    out[doc, item] = (similarity, start)
    return out


def test_decontaminate(spark):
    rng = random.Random(3)
    items = [(i, words(rng, rng.randint(15, 60))) for i in range(30)] + [(90, "only three words"), (91, None), (92, "")]
    texts = [(doc, text) for doc, text in EDGE if len(text or "") < 1000] + [(1, f"{words(rng, 50)} {items[0][1].upper()} {words(rng, 9)}"), (3, words(rng, 300)), (4, items[2][1]), (5, " ".join(items[3][1].split()[:8]) + " " + words(rng, 80)), (6, "a only three words b"), (7, items[5][1].split(" ", 3)[3])]
    long = words(rng, 200).split()
    items.append((95, " ".join(long)))
    texts.append((8, " ".join([*words(rng, 30).split(), *["same"] * 11, *long[:90], *long[112:], *["same"] * 11, *words(rng, 30).split()])))  # a passage that lacks its middle
    moved = words(rng, 60).split()
    items.append((96, " ".join(moved)))
    texts.append((9, " ".join([*words(rng, 40).split(), *moved[8:], *moved[:8], *words(rng, 40).split()])))  # one whose beginning moved to its end
    for i in range(150):  # passages with some words changed, left out or put in
        w = items[rng.randrange(30)][1].split()
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[], ["new"], [w[at], "more"]])
        texts.append((1000 + i, f"{words(rng, rng.randint(0, 30))} {' '.join(w)} {words(rng, rng.randint(0, 30))}"))
    found = decontaminate.contaminations(table(spark, texts), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    got = {(r.doc_id, r.item_id): r for r in found}
    expected = {k: v for k, v in best_windows(texts, items).items() if v[0] >= 0.8 - 1e-9}
    assert {(1, 0), (4, 2), (6, 90), (8, 95), (9, 96)} <= set(got) <= set(expected) and len(found) == len(got)
    assert len(got) >= 0.98 * len(expected) > 50  # recall of the fingerprints
    same = [k for k, r in got.items() if r.similarity == pytest.approx(expected[k][0]) and r.start_word == expected[k][1]]
    assert len(same) >= 0.98 * len(got) and all(r.hamming <= decontaminate.RADIUS for r in found)


def test_decontaminate_nulls_repeats_ties_long_texts_and_empty_tables(spark):
    rng = random.Random(14)
    item = words(rng, 20)
    items = [(1, item), (1, item), (1, words(rng, 20)), (2, item), (None, item), (3, None)]
    long = words(rng, 60_000) + f" {item} " + words(rng, 10)
    texts = [(5, item), (5, item), (5, "other text"), (None, item), (None, "none"), (6, f"{item} {item}"), (7, long), *EDGE]
    of_items = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1)).withColumn("row", F.lit(2))
    got = sorted((r.doc_id or 0, r.item_id, r.start_word) for r in decontaminate.contaminations(table(spark, texts).withColumn("row", F.lit(1)).withColumn("n", F.lit(1)), of_items).collect())
    assert got == sorted([(d, i, s) for d, s in ((5, 0), (5, 0), (0, 0), (6, 0), (7, 60_000)) for i in (1, 2)])
    empty = of_items.where("false")
    assert decontaminate.contaminations(table(spark, []), of_items).count() == decontaminate.contaminations(table(spark, texts), empty).count() == 0


def test_toxicity(spark):
    rng = random.Random(4)
    bad = ["idiot", "moron", "stupid"]
    texts = [(i, words(rng, 40) + (f" {rng.choice(bad)} " if i % 4 == 0 else " ") + words(rng, 20)) for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in texts] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.train(table(spark, [*texts, texts[0], (None, "stupid"), (7, None)]), labels)
    test = [*EDGE, (1, words(rng, 30)), (2, "you idiooot " + words(rng, 10)), (3, "so st0pid m0r0n " + words(rng, 10)), (4, "an i d i o t " + words(rng, 10)), (4, "an i d i o t"), (None, "m o r o n"), (5, words(rng, 20_000) + " 1d10t")]
    got = [(r.doc_id, r.score) for r in toxicity.scored(table(spark, test), model).collect()]
    assert len(got) == len(test)
    assert all(p >= 0.5 for i, p in got if i in (2, 3, 4, 5, None)) and all(p < 0.5 for i, p in got if i in (1, *(i for i, _ in EDGE)))
    assert toxicity.scored(table(spark, []), model).count() == 0
    none = toxicity.train(table(spark, []), labels)
    assert toxicity.scored(table(spark, test[:2]), none).count() == 2


COMMON = "you are a an and the fool is this stupid moron idiot shit asshole ass hole man what said they were not here some of his in that it good house".split()


def restorer():
    counts = defaultdict(int)
    for w in COMMON:
        for i in range(len(w) + 1):
            counts[f"  {w} "[i : i + 3]] += 20
    return toxicity.Restorer(toxicity.trigram_costs(counts))


def test_spaced_letters_are_cut_into_words():
    for text, word in [("you are a m o r o n", "moron"), ("y o u i d i o t", "idiot"), ("y o u a r e a s t u p i d m o r o n a n d t h e i d i o t", "stupid"), ("y.o.u m 0 r 0 n", "moron"), ("s t u u u p i d", "stupid"), ("i d i o t s t u p i d", "idiot"), ("i d i o t s t u p i d", "stupid")]:
        assert word in restorer().words(text), text


def test_decoding_equals_exhaustive_search():
    """Every reading of small lattices, scored by itself."""
    model, rng = restorer().model, random.Random(13)

    def readings(piece):
        runs = [(m[0][0], len(m[0]), m.start()) for m in re.finditer(r"(.)\1*", piece)]
        inside = [i for i, c in enumerate(piece) if c.isalpha()]
        found, before = [("", 0.0)], ""
        for c, size, start in runs:
            if c == " ":
                options = [("", 0.0), (" ", toxicity.BOUNDARY)]
            elif c.isalpha():
                options = [(c * size, 0.0)] + [(c, toxicity.REPEAT)] * (size > 1) + [(c * 2, toxicity.REPEAT)] * (size > 2) + [("", toxicity.REPEAT)] * (c == before)
            else:
                edge = inside and not inside[0] < start < inside[-1]
                none = toxicity.NOTHING if not edge else toxicity.MARK if c in "!|+" and start > inside[-1] else toxicity.EDGE_NOTHING
                options = [("", none)] + [(x * k, toxicity.SIGN * k + toxicity.REPEAT * (k != size)) for x in toxicity.LEET.get(c, "") for k in {1, min(size, 2)}]
            before = c if c != " " else before
            found = [(t + o, cost + price) for t, cost in found for o, price in options]
        return found

    def cost(text):
        total, s = 0.0, "  "
        for x in text + " ":
            total += model.get(s + x, model[""])
            s = "  " if x == " " else s[1] + x
        return total

    for _ in range(200):
        piece = "".join(rng.choice(["a", "s", "i", "d", "o", "t", "m", "1", "0", "$", "!", "@"]) * rng.choice([1, 1, 2, 3]) for _ in range(rng.randint(1, 5)))
        if rng.random() < 0.3:
            piece = " ".join(piece[:6])
        text, found = toxicity.decode(piece, model)
        assert found == pytest.approx(min(price + cost(t) for t, price in readings(piece))), piece


def test_signs_and_repeats_of_any_share_and_length_are_decoded():
    r = restorer()
    for written, word in [("5h17", "shit"), ("1d107", "idiot"), ("a$$", "ass"), ("57upid", "stupid"), ("@$$hole", "asshole"), ("iiiiidddddiiiiioooootttttt", "idiot"), ("idiooot!", "idiot"), ("moron!!", "moron"), ("2024", "2024"), ("@$$", "ass"), ("a55", "ass"), ("$h17", "shit"), ("stuupid", "stupid"), ("idio" + "o" * 30 + "t", "idiot"), ("good", "good"), ("$100", "$100")]:
        assert r[written] == word, written
    assert len(r["a1" * 50_000]) <= 100_000


def test_cross_entropy_difference(spark):
    rng = random.Random(5)
    a, b = [words(rng, 1) for _ in range(30)], [words(rng, 1) for _ in range(30)]
    texts = [(i, " ".join(rng.choice(a if i % 2 else b) for _ in range(50))) for i in range(80)] + EDGE
    got = {r.doc_id: r for r in lm_score.cross_entropy_difference(table(spark, texts), spark.createDataFrame([(i,) for i in range(1, 40, 2)], "doc_id bigint")).collect()}
    assert len(got) == len(texts) and got[900].n_tokens == 0 and got[900].score == 0
    assert min(got[i].score for i in range(1, 80, 2)) > max(got[i].score for i in range(0, 80, 2))
    assert lm_score.cross_entropy_difference(table(spark, []), spark.createDataFrame([], "doc_id bigint")).count() == 0


def test_cross_entropy_difference_counts_exactly(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "CELL", 20_000)
    rng = random.Random(8)
    texts = [(i, words(rng, 150)) for i in range(1100)] + [(7, "again and again and"), (None, "no id"), *EDGE]
    targets = set(range(0, 1100, 3))
    got = lm_score.cross_entropy_difference(table(spark, texts), spark.createDataFrame([(i,) for i in targets], "doc_id bigint")).collect()
    single, pair, context = ([defaultdict(int) for _ in range(2)] for _ in range(3))
    split = [(i, [None, *(t or "").split()]) for i, t in texts]
    for i, w in split:
        for m in range(1 + (i in targets)):
            for a, b in zip(w, w[1:]):
                single[m][b] += 1
                pair[m][a, b] += 1
            if len(w) > 1:
                context[m][None] += 1
    assert len(single[0]) > 1 << 16 and len(pair[0]) > 1 << 17

    def loss(m, w):
        total = sum(single[m].values())
        each = []
        for a, b in zip(w, w[1:]):
            before = context[m][None] if a is None else single[m][a]
            one = (single[m][b] + lm_score.ADD) / (total + lm_score.ADD * len(single[0]))
            each.append(-np.log((lm_score.MIX * pair[m][a, b] / before + (1 - lm_score.MIX) * one) if before else one))
        return float(np.mean(each)) if each else 0.0

    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    chosen = {1, 2, 3, 7, 907, None, *(i for i, _ in EDGE)}
    expected = sorted(((i, len(w) - 1, loss(1, w), loss(0, w)) for i, w in split if i in chosen), key=key)
    found = sorted((tuple(r)[:4] for r in got if r.doc_id in chosen), key=key)
    assert len(got) == len(texts) and [x[:2] for x in found] == [x[:2] for x in expected]
    assert np.allclose([x[2:] for x in found], [x[2:] for x in expected])


def test_mixing(spark):
    rng = random.Random(6)
    vocabulary = {d: [words(rng, 1) for _ in range(40)] for d in ("en", "de")}
    texts = [(i, " ".join(rng.choice(vocabulary["en" if i % 4 else "de"]) for _ in range(rng.randint(20, 80)))) for i in range(200)] + EDGE
    texts += [texts[0], (None, texts[1][1]), (777, " ".join(rng.choice(vocabulary["en"]) for _ in range(9000)))]
    labelled = spark.createDataFrame([(i, "en" if i % 4 else "de") for i in range(100)] + [(None, "en"), (5, None), (3, "other"), (12345, "de")], "doc_id bigint, domain string")
    got = mixing.mixed(table(spark, texts).withColumn("rate", F.lit(1)).withColumn("row", F.lit(1)), labelled, {"en": 0.5, "de": 0.5}).collect()
    p, r, t = (np.array([x[c] for x in got]) for c in ("posterior", "rate", "n_tokens"))
    share = (t * r) @ p
    assert (r >= 0).all() and len(got) == len(texts) and {x.n_tokens for x in got if x.doc_id in (900, 901, 902)} == {0}
    missed = abs(share - 0.5 * t.sum()).max() / t.sum()
    assert missed <= 2 * mixing.TOLERANCE and got[0].residual == pytest.approx(missed, abs=1e-9) and len({x.residual for x in got}) == 1
    assert [p[i, 0] > 0.5 for i, x in enumerate(got) if (x.doc_id or 0) < 100 and x.n_tokens] == [x.doc_id is not None and x.doc_id % 4 == 0 for x in got if (x.doc_id or 0) < 100 and x.n_tokens]
    empty = mixing.mixed(table(spark, []), labelled)
    assert empty.count() == 0 and mixing.mixed(table(spark, texts[:3]), labelled.where("false"), {"en": 1, "de": 1}).count() == 3


def test_fit_of_rates_against_plain_sums(spark):
    """Totals that can be met are met; where they cannot, the fit ends and reports the miss."""
    rng = np.random.default_rng(17)
    table_of = lambda p, t: spark.createDataFrame([(int(n), [float(x) for x in row]) for n, row in zip(t, p, strict=True)], "n_tokens bigint, posterior array<double>")
    p = rng.dirichlet([0.3] * 3, 300)
    t = rng.integers(1, 50, 300)
    shares = np.array([0.2, 0.3, 0.5])
    steps, residual = mixing.fit_rates(table_of(p, t), shares)
    total = (t * mixing.rates(p, steps)) @ p
    assert residual <= mixing.TOLERANCE and abs(total / t.sum() - shares).max() <= mixing.TOLERANCE + 1e-9
    # Every document belongs half to the second domain, so the first can have no more than the second.
    p = np.stack([rng.uniform(0, 0.5, 300), np.full(300, 0.5)], 1)
    p = np.column_stack([p, 1 - p.sum(1)])
    steps, residual = mixing.fit_rates(table_of(p, t), np.array([0.8, 0.1, 0.1]))
    total = (t * mixing.rates(p, steps)) @ p / t.sum()
    assert residual > 0.1 and residual == pytest.approx(abs(total - [0.8, 0.1, 0.1]).max())
