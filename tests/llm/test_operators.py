"""The document operators against plain versions, on small tables with awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from storeledger.llm import (  # noqa: E402
    common, decontaminate, fingerprints, near_dedup, pii_boosting, quality_crf, sampling, sketches, spans, substring_dedup, suffix_dedup, token_counts, token_files, unigram,
)
from storeledger.llm.common import components  # noqa: E402

SCHEMA = "doc_id long, text string, Text_Key string, ids string, score int, n_chars long"
BYTE, WORD, PIECE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdeiou lmnrst") for _ in range(pick.randint(2, 9))).strip() or "x" for _ in range(n))


ODD = ["", " ", "a", "two words", "it's  <|endoftext|> here\n\n", "naïve café ▁ mark", "tab\tand\x0bmore", "x" * 3000, "日本語 текст 🙂", "  a  b", "A\x00b c"]
LONG = prose(1, 30_000)
BASE = prose(2, 400)
ROWS = [(k, t) for k, t in enumerate(ODD)] + [
    (100, BASE), (101, BASE), (102, BASE + " one more"), (103, "before it " + BASE[:900] + " " + prose(3, 40)), (104, LONG),
    (105, prose(4, 60) + "\n" + prose(5, 60)), (106, None), (None, "no id of its own " + prose(6, 30)), (100, BASE),
]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "k", "i", 1, len(t or "")) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, []).limit(0)


def by_text(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def test_components(spark):
    pick = random.Random(7)
    edges = [(pick.randrange(200), pick.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 380)]
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


@pytest.fixture
def many_partitions(spark):
    """Shuffles of many partitions that Spark does not join."""
    held = {"spark.sql.shuffle.partitions": str(8 * spark.sparkContext.defaultParallelism), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield int(held["spark.sql.shuffle.partitions"])
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rounds_over_few_edges_have_few_tasks(spark, monkeypatch, many_partitions):
    real, files = common.staged, []

    def counted(df, label):
        out = real(df, label)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(common, "staged", counted)
    edges = [(k, k + 1) for k in range(0, 4000, 2)] + [(k, k + 2) for k in range(0, 1000, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 if k < 1002 else k - k % 2 for k in range(4000)}
    assert len(files) > 2 and max(files[1:]) <= spark.sparkContext.defaultParallelism


def test_edges_worth_more_tasks_get_them(spark, monkeypatch, many_partitions):
    monkeypatch.setattr(common, "EDGES_A_TASK", 10)
    rows = spark.range(0, 100, 1, many_partitions)
    cores = spark.sparkContext.defaultParallelism
    assert common._in_few_tasks(rows, 10 * (cores + 1)).rdd.getNumPartitions() == cores + 1
    assert common._in_few_tasks(rows, 10 * many_partitions).rdd.getNumPartitions() == many_partitions


def test_a_sketch_is_read_in_one_job(spark, many_partitions):
    keys = sampling.mix(np.arange(1, 5001, dtype=np.uint64)).view(np.int64).tolist()
    rows = spark.createDataFrame([(k,) for k in keys + keys[:100]], "key long").repartition(3)
    spark.sparkContext.setJobGroup("sketch", "sketch")
    try:
        bitmap = sketches.frequent_cells(rows, sketches.column_keys("key"), 24, 2)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    cells = collections.Counter(sketches.cell(np.array(keys + keys[:100], np.int64).view(np.uint64), 24).tolist())
    assert np.flatnonzero(np.unpackbits(bitmap, bitorder="little")).tolist() == sorted(c for c, n in cells.items() if n > 1)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("sketch")) < 8


def test_unigram_is_the_librarys(spark, docs, empty):
    """A unigram file of the same pieces and scores, read by the sentencepiece library, encodes alike."""
    import sentencepiece

    model = unigram.public_model(PIECE)

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def field(number, kind, body):
        return varint(number << 3 | kind) + (varint(len(body)) + body if kind == 2 else body)

    def piece(text, score, kind):
        return field(1, 2, field(1, 2, text.encode()) + field(2, 5, np.float32(score).tobytes()) + field(3, 0, varint(kind)))

    names = ["<unk>", *model.pieces]
    proto = piece("<unk>", 0, 2) + b"".join(piece(w, model.scores[k], 1) for w, k in model.pieces.items()) + b"".join(piece(f"<0x{b:02X}>", 0, 6) for b in range(256))
    proto += field(2, 2, field(3, 0, b"\1") + field(35, 0, b"\1"))  # unigram, with byte fallback
    proto += field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\1") + field(4, 0, b"\0") + field(5, 0, b"\1"))
    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    names += [f"<0x{b:02X}>" for b in range(256)]
    byte_ids = set(model.byte_ids)
    for text in [*ODD[:10], BASE, LONG[:20_000]]:
        marked = unigram.MARK + text.replace(" ", unigram.MARK)
        ids, score, _ = model.viterbi(marked) if text else ([], 0.0, 0)
        theirs = [names[k] for k in library.encode(text)]
        ours = [f"<0x{model.byte_ids.index(k):02X}>" if k in byte_ids else model.surface[k].decode() for k in ids]
        if ours != theirs:  # only between paths whose scores differ by less than 32-bit sums can tell
            assert not any(p in theirs for p in names[-256:]), text[:40]
            assert sum(model.scores[model.pieces[p]] for p in theirs) == pytest.approx(score, rel=1e-5)


def test_unigram_round_trip(docs, empty):
    back = unigram.decode(unigram.encode(docs, PIECE), PIECE, ids="ids_")
    assert back.columns == [*docs.columns, "ids_", "decoded"]
    for row in back.collect():
        text = row.text or ""
        assert row.decoded == text.replace(unigram.MARK, " ")
        assert (len(row.ids_) == 0) == (text == "")
    model = unigram.public_model(PIECE)
    for row in unigram.unigram_digest(docs, PIECE).collect():
        options = [t or "" for i, t in ROWS if i == row.doc_id]
        wanted = [model.viterbi(unigram.MARK + t.replace(" ", unigram.MARK)) if t else ([], 0.0, 0) for t in options]
        assert (row.n_ids, row.ids_crc32) in [(len(ids), zlib.crc32(np.array(ids, "<i4"))) for ids, _, _ in wanted]
    assert unigram.unigram_digest(empty, PIECE).isEmpty()


def test_unigram_decodes_in_the_worker_that_encodes(spark, docs):
    import corpus_pipeline

    both = corpus_pipeline.pieces(spark, docs, "")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
    apart = unigram.decode(unigram.encode(docs, PIECE), PIECE, ids="ids_")
    assert both.columns == apart.columns
    assert sorted(map(repr, both.collect())) == sorted(map(repr, apart.collect()))


def test_viterbi_is_best_of_all_paths():
    pieces = {"▁": (0, -2.0), "▁a": (1, -1.5), "a": (2, -2.5), "b": (3, -3.0), "ab": (4, -2.0), "▁ab": (5, -4.1), "ba": (6, -3.3), "aba": (7, -4.0)}
    model = unigram.Unigram(pieces, list(range(1000, 1256)))

    def best(text):
        if not text:
            return 0.0
        ways = [s + best(text[len(p):]) for p, (_, s) in pieces.items() if text.startswith(p)]
        if text[0] not in pieces:
            ways.append(model.unknown + best(text[1:]))
        return max(ways)

    pick = random.Random(3)
    for _ in range(200):
        text = "▁" + "".join(pick.choice("ab▁é") for _ in range(pick.randint(0, 9)))
        assert math.isclose(model.viterbi(text)[1], best(text))


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BYTE)
    want = by_text((i, len((t or "").encode()), len(plain.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS)
    got = token_counts.token_counts(docs, BYTE).collect()
    assert sorted(want, key=str) == sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = token_counts.token_counts(docs, PIECE).collect()
    assert sorted((r.n_tokens for r in got)) == sorted(len(whole.encode(t or "")) for _, t in ROWS)
    assert token_counts.token_counts(empty, BYTE).isEmpty()


def test_token_files(docs, empty):
    from tokenizers import Tokenizer

    plain, at, want = Tokenizer.from_file(WORD), 0, []
    for i, t in by_text([(i, t or "") for i, t in ROWS]):
        ids = plain.encode(t, add_special_tokens=False).ids + [1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        at += len(ids)
    got = token_files.token_files(docs, WORD, 1).collect()
    assert sorted(want, key=lambda r: r[1]) == sorted((tuple(r) for r in got), key=lambda r: r[1])
    assert token_files.token_files(empty, WORD, 1).isEmpty()


def test_quality(spark, empty):
    pick = random.Random(5)
    good = [(k, "\n".join(prose(1000 + 7 * k + j, 40).capitalize() + "." for j in range(1 + k % 4))) for k in range(150)]
    bad = [(500 + k, "\n".join(" | ".join(prose(9000 + k, 12).upper().split()) + " !!" for _ in range(1 + k % 3))) for k in range(150)]
    pick.shuffle(good)
    docs = table(spark, good + bad + [(900, ""), (901, None)])
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad], "doc_id long, quality int, toxic int")
    chain = quality_crf.fit(docs, labels)
    scored = quality_crf.quality_scores(docs, chain)
    assert scored.columns == [*docs.columns, "score_"]
    rows = scored.withColumn("out", quality_crf.held_out(F.col("doc_id"))).collect()
    tested = [r for r in rows if r.out and r.doc_id < 900]
    assert sum((r.score_ >= 0.5) == (r.doc_id < 500) for r in tested) >= 0.98 * len(tested)
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score_ <= 1 for r in rows)
    assert len({r.score_ for r in rows if r.doc_id >= 900}) == 1
    kept = quality_crf.keep_good(docs, chain)
    assert kept.columns == docs.columns
    assert quality_crf.keep_good(empty, chain).isEmpty()
    flat = quality_crf.fit(empty, labels)
    assert all(r.score_ == pytest.approx(0.5, abs=0.05) for r in quality_crf.quality_scores(docs, flat).collect())


def test_marginals_by_enumeration():
    pick = np.random.default_rng(2)
    chain = quality_crf.Chain(np.zeros(1), pick.normal(size=(2, 2)))
    score, of_text = pick.normal(size=7), np.array([0, 1, 4, 7])
    odds, _, _ = chain.marginals(score, of_text)
    for a, b in zip(of_text[:-1], of_text[1:], strict=True):
        weight = collections.Counter()
        for labels in np.ndindex(*[2] * (b - a)):
            total = sum(score[a + t] * y for t, y in enumerate(labels)) + sum(chain.pairs[x, y] for x, y in zip(labels, labels[1:], strict=False))
            for t, y in enumerate(labels):
                weight[a + t, y] += math.exp(total)
        for t in range(a, b):
            assert odds[t] == pytest.approx(math.log(weight[t, 1] / weight[t, 0]))


def plain_spans(text):
    out = []
    for kind, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0 if kind == 2 else True
            if kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split(".")) or kind == 2 and 14 <= len(digits) <= 19 and luhn or kind == 3 and 10 <= len(digits) <= 15:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_base_spans():
    pick = random.Random(11)
    for _ in range(3000):
        text = "".join(pick.choice(["a@b.co", "@", ".", "-", "+", " ", "1", "25", "4111 1111 1111 1111", "+44 (0)20 7946 0018", "192.168.0.1", "é", "x", "%", "_", "256.1.1.1", "("]) for _ in range(pick.randint(1, 9)))
        assert pii_boosting.base_spans(text) == plain_spans(text), text


def test_personal_data(spark, empty):
    rows = [(k, f"write to user{k}@mail.example.org or call +1 (555) 010-{1000 + k} now") for k in range(60)] + [(200, "4539 1488 0343 6467 from 10.20.30.40"), (201, prose(8, 30)), (202, None), (203, "")]
    docs = table(spark, rows)
    model = pii_boosting.fit(docs)
    text_of = dict(rows)
    for r in pii_boosting.personal_data(docs, model).collect():
        base = plain_spans(text_of[r.doc_id] or "")
        written = ",".join(f"{pii_boosting.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in range(4))
        assert set(filter(None, written.split(","))) <= set(r.spans.split(","))
        if r.doc_id in (201, 202, 203):
            assert r.spans == ""
    clean = {r.doc_id: r for r in pii_boosting.redact_documents(docs, model).collect()}
    assert clean[200].text == "[CARD] from [IP]" and clean[200].n_chars == 16
    assert clean[201].text == text_of[201] and clean[202].text is None
    assert pii_boosting.personal_data(empty, pii_boosting.NO_TREES).isEmpty()
    assert pii_boosting.fit(empty) is pii_boosting.NO_TREES


def test_spans_beyond_the_rules(spark):
    """Addresses with spelt-out signs and phone numbers without a plus sign are added; numbers that cannot be cards are not."""
    pick, rows, hidden = random.Random(31), [], set()
    for k in range(600):
        if pick.random() < 0.1:
            hidden.add(k)
            rows.append((k, f"write to user{k} [at] mail [dot] example [dot] org or call 1 (555) 010-{1000 + k} now"))
        else:
            rows.append((k, f"write to user{k}@mail.example.org or call +1 (555) 010-{1000 + k} now"))
    rows += [(1000 + k, f"order 4539 1488 0343 {6000 + k} of the list") for k in range(200) if not pii_boosting.luhn(f"453914880343{6000 + k}")]
    docs = table(spark, rows)
    for r in pii_boosting.redact_documents(docs, pii_boosting.fit(docs)).collect():
        assert r.text == ("write to [EMAIL] or call [PHONE] now" if r.doc_id < 1000 else dict(rows)[r.doc_id]), r.doc_id in hidden


def test_trees_find_the_rule():
    pick = np.random.default_rng(4)
    rows = pick.normal(size=(3000, 6))
    rows[:, :4] = np.eye(4)[pick.integers(4, size=3000)]
    labels = ((rows[:, 4] > 0.3) & (rows[:, 5] < 0.5)).astype(float)
    model = pii_boosting.boost(rows, labels)
    assert np.mean((model.log_odds(rows) > 0) == labels) > 0.98 and np.isfinite(model.thresholds).all()


def jaccard(a, b):
    return sum(min(a[k], b[k]) for k in a.keys() & b.keys()) / sum(max(a.get(k, 0), b.get(k, 0)) for k in a.keys() | b.keys())


def test_samples_agree_as_often_as_sets_are_alike():
    pick = np.random.default_rng(9)
    terms = pick.integers(1 << 62, size=300).astype(np.uint64)
    a = {int(t): float(w) for t, w in zip(terms[:220], pick.exponential(2, 220), strict=True)}
    b = {k: v * pick.choice([1.0, 1.0, 2.0]) for k, v in list(a.items())[40:]} | {int(t): 1.5 for t in terms[220:]}
    seed = sampling.seeds(8192)
    drawn = [sampling.blocks(np.array(list(s), np.uint64), np.array(list(s.values())), seed) for s in (a, b)]
    assert sampling.likeness(*drawn) == pytest.approx(jaccard(a, b), abs=0.025)


def test_fingerprints(spark, docs, empty):
    order = by_text([(i, t or "") for i, t in ROWS])
    want = []
    for k, (i, text) in enumerate(order):
        cut = len(text) // 4
        following = order[(k + 1) % len(order)][1]
        edited = text[: len(text) - cut] + following[:cut]
        f, e, n = (fingerprints.fingerprint(x) for x in (text, edited, following))
        same = [sum(f[j : j + 8] == x[j : j + 8] for j in range(0, len(f), 8)) / fingerprints.SAMPLES for x in (e, n)]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), f, e, *same))
    for range_bytes in (1 << 30, 300):
        got = [tuple(r) for r in fingerprints.fingerprints(docs, range_bytes=range_bytes).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert fingerprints.fingerprints(empty).isEmpty()
    alone = fingerprints.fingerprints(table(spark, [(7, BASE)])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_decontaminate(spark, docs, empty):
    items = [(1, BASE[:500].rsplit(" ", 1)[0]), (2, prose(50, 30)), (3, LONG[40_000:41_500].split(" ", 1)[1].rsplit(" ", 1)[0]), (4, "two words"), (5, ""), (6, None), (7, LONG[:3000].rsplit(" ", 1)[0].upper()), (1, BASE[:500].rsplit(" ", 1)[0])]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")

    def sets(text):
        words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").lower())
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    want = {(i, j) for i, t in ROWS for j, x in items if sets(x) and len(sets(t) & sets(x)) >= 0.8 * len(sets(x))}
    assert {(100, 1), (104, 3), (104, 7), (3, 4)} <= want
    assert {(r.doc_id, r.item_id) for r in decontaminate.contained_items(docs, benchmark).collect()} == want
    kept = decontaminate.drop_contaminated(docs, benchmark)
    bad = {i for i, _ in want}
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in ROWS if i not in bad)
    assert decontaminate.contained_items(empty, benchmark).isEmpty() and decontaminate.contained_items(docs, benchmark.limit(0)).isEmpty()


def test_short_items_inside_documents(spark):
    """Items of one to four words are found wherever their words stand in a row, by words and not by letters."""
    items = spark.createDataFrame([("one", "Zanzibar"), ("two", "quick  fox"), ("three", "a b c"), ("four", "what is the answer"), ("five", "so here are five words")], "item_id string, text string")
    filler = prose(50, 40)
    docs = table(spark, [(1, f"{filler} zanzibar {filler}"), (2, f"{filler} Quick\nfox"), (3, f"a b c {filler}"), (4, f"{filler} What is the answer so here are five words"),
        (5, "quick fox"), (6, f"{filler} quick brown fox zanzibars a b what is the {filler}"), (7, "a b"), (8, "")])
    got = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in decontaminate.contained_items(docs, items).collect()}
    assert got == {(1, "one", 1, 1), (2, "two", 1, 1), (3, "three", 1, 1), (4, "four", 1, 1), (4, "five", 1, 1), (5, "two", 1, 1)}
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()} == {6, 7, 8}


@pytest.mark.parametrize("small", [24, 0])
def test_near_duplicates(spark, empty, small, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", small)
    pick, rows = random.Random(21), [(None, "some text without an id of its own"), (900, ""), (901, None), (902, " \n ")]
    for family in range(12):
        words = prose(700 + family, 150).split(" ")
        rows.append((10 * family, " ".join(words)))
        for k in range(1, 8):
            edited = list(words)
            for _ in range(family % 6):
                edited[pick.randrange(len(edited))] = f"w{pick.random()}"
            rows.append((10 * family + k, " ".join(edited)))
    docs = table(spark, rows).repartition(3)
    weigh = near_dedup.weights(near_dedup._named(docs))
    sets = [np.unique(sampling.shingle_hashes(sampling.word_hashes([t or ""])[0]), return_counts=True) for _, t in rows]
    root = list(range(len(rows)))
    order = [-1 if i is None else i for i, _ in rows]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if near_dedup.weighted_jaccard(sets[a], sets[b], weigh) >= 0.8:
                x, y = sorted((find(a), find(b)), key=lambda k: order[k])
                root[y] = x
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: rows[find(k)][0] for k, (i, _) in enumerate(rows)}
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {rows[find(k)][0] for k in range(len(rows))}
    assert near_dedup.near_duplicates(empty).isEmpty() and near_dedup.keep_one(empty).isEmpty()


def test_document_frequencies(spark):
    rows = [(k, f"shared words stand in every one {'of half of them here ' * (k % 2)} {prose(k, 20)}") for k in range(300)]
    weigh = near_dedup.weights(near_dedup._named(table(spark, rows)))
    counts = collections.Counter(h for _, t in rows for h in set(sampling.shingle_hashes(sampling.word_hashes([t])[0]).tolist()))
    want = {h: n for h, n in counts.items() if n >= 3}
    assert dict(zip(weigh.frequent[:-1].tolist(), weigh.idf[:-1].tolist(), strict=True)) == {h: pytest.approx(math.log1p(300 / n)) for h, n in want.items()}


def test_components_are_found_again_only_after_new_links(spark, monkeypatch):
    calls, found = [], near_dedup.components
    monkeypatch.setattr(near_dedup, "components", lambda edges: calls.append(1) or found(edges))
    docs = spark.createDataFrame([(1, prose(1, 60)), (2, prose(1, 60) + " more"), (3, prose(2, 60))], "doc_id long, text string")
    assert {(r.doc_id, r.class_id) for r in near_dedup.near_duplicates(docs).collect()} == {(1, 1), (2, 1), (3, 3)}
    assert len(calls) == 1


def test_components_are_not_found_again_if_frequencies_add_no_link(spark, monkeypatch):
    calls, found = [], near_dedup.components
    monkeypatch.setattr(near_dedup, "components", lambda edges: calls.append(1) or found(edges))
    own = prose(82, 600).split(" ")[:384]
    rows = [(k, " ".join(own + [f"only{k}x{m}" for m in range(49)])) for k in range(2)]  # at 0.795 by plain counts
    rows += [(2, prose(3, 60)), (3, prose(3, 60) + " more")]
    assert {(r.doc_id, r.class_id) for r in near_dedup.near_duplicates(table(spark, rows)).collect()} == {(0, 0), (1, 1), (2, 2), (3, 2)}
    assert len(calls) == 1


def test_near_duplicates_of_a_hot_group(spark):
    """Edited copies of a text that a third of the rows hold stay copies of it; rows of their own stay apart."""
    words, pick, rows = prose(40, 400).split(" "), random.Random(41), [(k, prose(900 + k, 60)) for k in range(1000, 1200)]
    for k in range(100):
        edited = list(words)
        for place in pick.sample(range(10, 380, 6), 8 if k % 4 == 3 else 0):
            edited[place] = f"w{pick.random()}"
        rows.append((k, " ".join(edited)))
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(table(spark, rows).repartition(3)).collect()}
    assert got == {i: 0 if i < 100 else i for i, _ in rows}


def test_row_counts(spark):
    """Shingles of a few rows, fewer than a frequent one has, are counted too."""
    rows = [(k, f"{prose(k // 2, 20)} {prose(5000 + k, 20)} shared words stand in every one") for k in range(600)]
    named = near_dedup._named(table(spark, rows).repartition(3))
    weigh = near_dedup.weights(named)
    sets = {i: set(sampling.shingle_hashes(sampling.word_hashes([t])[0]).tolist()) for i, t in rows}
    counts = collections.Counter(h for found in sets.values() for h in found)
    for r in near_dedup._counted(named, near_dedup.row_counts(named, weigh)).collect():
        got = dict(zip((h % 2**64 for h in r.shingles), r.dfs, strict=True))
        assert got == {h: counts[h] for h in sets[r.doc_id] if 2 <= counts[h] < 6}
        terms = np.array(sorted(got), np.uint64)
        want = [1 + near_dedup.SPREAD * math.log1p(600 / counts[h]) / math.log1p(600) for h in terms.tolist()]
        assert weigh.of(terms, np.ones(len(terms)), (np.array(list(got), np.uint64), np.array(list(got.values())))).tolist() == pytest.approx(want)


def test_pairs_that_frequencies_decide(spark):
    """At 0.795 by plain counts, two texts are copies if what differs is common, and are not if it is rare."""
    ends = [prose(70 + k, 120).split(" ")[:49] for k in range(2)]
    own, other = prose(81, 600).split(" ")[:384], prose(82, 600).split(" ")[:384]
    rows = [(k, " ".join(own + ends[k])) for k in range(2)]
    rows += [(2 + k, " ".join(other + [f"only{k}x{m}" for m in range(49)])) for k in range(2)]
    rows += [(k, " ".join([f"row{k}x{m}" for m in range(60)] + ends[k % 2])) for k in range(4, 300)]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(table(spark, rows).repartition(3)).collect()}
    assert got == {i: 0 if i < 2 else i for i, _ in rows}


def test_bound_of_weighted_similarity():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = (np.unique(rng.integers(1, 40, rng.integers(1, 60)).astype(np.uint64), return_counts=True) for _ in range(2))
        terms = np.union1d(a[0], b[0])
        weigh = near_dedup.Weights(terms, rng.integers(1, 500, len(terms)), 500)
        wa, wb = ({int(t): n * (1 + near_dedup.SPREAD * math.log1p(500 / weigh_df) / math.log1p(500)) for t, n, weigh_df in zip(x[0], x[1], 500 / np.expm1(weigh.idf[np.searchsorted(terms, x[0])]), strict=True)} for x in (a, b))
        both, union = (sum(f(wa.get(t, 0), wb.get(t, 0)) for t in map(int, terms)) for f in (min, max))
        plain, most = near_dedup.plain_and_most(a, b)
        assert both / union <= most + 1e-12 and plain <= most


def test_bound_of_parities():
    """Sizes and parities never rule out a pair that can be similar enough, and rule out most others."""
    rng, ruled_out = np.random.default_rng(6), 0
    for k in range(400):
        own = rng.integers(1, 1 << 63, rng.integers(0, 1500)).astype(np.uint64)
        cut = int(len(own) * (1 - rng.random() / 3))
        other = np.append(own[:cut], rng.integers(1, 1 << 63, rng.integers(0, 200)).astype(np.uint64))
        a, b = (np.unique(np.append(x, x[: k % 7]), return_counts=True) for x in (own, other))
        sizes = [int(x[1].sum()) for x in (a, b)]
        apart = max(abs(sizes[0] - sizes[1]), int(np.bitwise_count((near_dedup.parity(*a) ^ near_dedup.parity(*b)).view(np.uint64)).sum()))
        out = apart > near_dedup.most_apart(float(sum(sizes)), 0.8)
        assert not (out and near_dedup.plain_and_most(a, b)[1] >= 0.8)
        ruled_out += out
    assert ruled_out > 100


def test_pairs_of_a_large_bucket(spark, monkeypatch):
    """Many texts that share half of their words are in large buckets; only the pairs that can be alike are compared."""
    met = []
    real = near_dedup._compared
    monkeypatch.setattr(near_dedup, "_compared", lambda pairs, *more: met.append(pairs.count()) or real(pairs, *more))
    shared, rows = prose(7, 260), []
    for k in range(150):
        words = (shared + " " + " ".join(f"own{k}x{m}" for m in range(240))).split(" ")
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:-2], "two", "more"]))]
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(table(spark, rows).repartition(3)).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
    assert sum(met) < 2 * len(rows)


def test_texts_outside_a_large_class_meet_some_of_it_first(spark, monkeypatch):
    """Texts that are copies of a class, but not of each other, are not compared with all of it, nor with each other."""
    met, real, pick = [], near_dedup._compared, random.Random(1)
    monkeypatch.setattr(near_dedup, "_compared", lambda pairs, *more: met.append(pairs.count()) or real(pairs, *more))
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 8)
    monkeypatch.setattr(near_dedup, "PIVOTS", 2)
    words, rows = prose(17, 250).split(" ")[:150], []
    for k in range(240):
        edited = list(words)
        for place in pick.sample(range(6, 140, 6), 1 if k < 40 else 2):
            edited[place] = f"w{k}x{place}"
        rows.append((k, " ".join(edited)))
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(table(spark, rows).repartition(3)).collect()}
    assert set(got.values()) == {0}
    assert sum(met) < 5 * len(rows)


def shared_passages():
    pick, passages = random.Random(31), [prose(60 + k, 60) for k in range(6)]
    rows = [(None, passages[0] + " " + prose(99, 20)), (77, None), (78, "")]
    for k in range(40):
        body = [prose(300 + k, pick.randint(0, 60))]
        for _ in range(pick.randint(0, 3)):
            passage, a = pick.choice(passages), pick.randint(0, 60)
            body += [passage[a : a + pick.randint(100, 500)], prose(900 + pick.randrange(9), 5)]
        rows.append((k, "\n".join(body)))
    return [*rows, (50, "same " * 200), (51, "same " * 120), (52, BASE), (53, BASE), (3, BASE), (52, BASE)]


def test_substring_dedup(spark, empty):
    rows = shared_passages()
    split = [(-1 if i is None else i, re.findall(r"[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    first = {}
    for i, words in split:
        for k in range(len(words) - 12):
            window = tuple(words[k : k + 13])
            first[window] = min(first.get(window, i), i)
    want = []
    for (i, _), (order, words) in zip(rows, split, strict=True):
        gone = [False] * len(words)
        for k in range(len(words) - 12):
            if first[tuple(words[k : k + 13])] < order:
                gone[k : k + 13] = [True] * 13
        want.append((i, len(words), sum(gone), " ".join(w for w, x in zip(words, gone, strict=True) if not x)))
    got = substring_dedup.remove_repeats(table(spark, rows).repartition(3)).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(want, key=str) == sorted((tuple(r) for r in got), key=str)
    assert substring_dedup.remove_repeats(empty).isEmpty()


def test_substring_dedup_writes_short_windows(spark, monkeypatch):
    """Windows of contested spans are written with the number of their span in place of its hashes."""
    written = {}
    real = substring_dedup.staged
    monkeypatch.setattr(substring_dedup, "staged", lambda df, label: written.setdefault(label, []).append(df.columns) or real(df, label))
    assert substring_dedup.remove_repeats(table(spark, shared_passages())).count() > 0
    assert [c for label, c in written.items() if "windows" in label] == 2 * [[["span", "earliest", "offset", "w_low", "w_high"]]]


def test_spans_that_occur_once_are_not_written(spark, monkeypatch):
    """However many anchors there are for a bit of the sketch, if few of them repeat; and no query's shuffle files stay."""
    monkeypatch.setattr(spans, "LEAST_BITS", 14)
    monkeypatch.setattr(spans, "MOST_BITS", 14)
    written, real, key = {}, substring_dedup.staged, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)

    def counted(df, label):
        out = real(df, label)
        written[label] = out.count(), spark.conf.get(key)
        return out

    monkeypatch.setattr(substring_dedup, "staged", counted)
    rows = [(k, prose(1000 + k, 2000) + (" " + BASE if k < 5 else "")) for k in range(100)]
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(table(spark, rows).repartition(3)).collect()}
    n = len(BASE.split())
    assert [got[k] for k in range(1, 5)] == 4 * [n] and not got[0] and max(got[k] for k in range(5, 100)) == 0
    assert n / 9 < written["spans"][0] < 5 * n
    assert {deleted for _, deleted in written.values()} == {"true"} and spark.conf.get(key) == before


def test_keys_that_occur_once_are_not_marked(spark):
    keys = sampling.mix(np.arange(1, 2_000_001, dtype=np.uint64)).view(np.int64)
    twice = keys[:5000]
    rows = spark.createDataFrame(pa.table({"key": np.concatenate([keys, twice])})).repartition(3)
    bitmap = sketches.frequent_keys(rows, sketches.column_keys("key"), 20, 2)
    marked = sketches.is_marked(bitmap, keys.view(np.uint64), 20)
    assert marked[:5000].all() and marked[5000:].mean() < 0.001




@pytest.mark.parametrize("split", [2_000, 1])
def test_suffix_dedup(spark, empty, split, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SPLIT_SPANS", split)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 1 << 20 if split > 1 else 1 << 11)
    rows, length = shared_passages(), 200
    raw = [(t or "").encode() for _, t in rows]
    count = collections.Counter(t[k : k + length] for t in raw for k in range(len(t) - length + 1))
    want = []
    for (i, _), t in zip(rows, raw, strict=True):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        want.append((i, len(t), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.remove_repeats(table(spark, rows).repartition(3)).drop("kept").collect()
    assert sorted(want, key=str) == sorted((tuple(r) for r in got), key=str)
    assert suffix_dedup.remove_repeats(empty).isEmpty()


def test_repeated_starts():
    pick = random.Random(1)
    for trial in range(200):
        length = pick.choice([1, 2, 5, 9, 20])
        letters = b"ab\x00" if trial % 2 else b"abcdefgh"
        spans = list({bytes(pick.choice(letters) for _ in range(pick.randint(length, 60))) for _ in range(pick.randint(1, 8))})
        count = collections.Counter(s[k : k + length] for s in spans for k in range(len(s) - length + 1))
        want = [[count[s[k : k + length]] > 1 for k in range(len(s) - length + 1)] for s in spans]
        assert [x.tolist() for x in suffix_dedup.repeated_starts(spans, length)] == want


def test_line_features_of_batches_and_alone():
    texts = [t for t in ODD if t] + [BASE, "a\n\nb\n", "\n"]
    every, sizes, of_text = quality_crf.line_features(pa.array(texts))
    for k, text in enumerate(texts):
        one, size, _ = quality_crf.line_features(pa.array([text]))
        assert (every[of_text[k] : of_text[k + 1]] == one).all() and (sizes[of_text[k] : of_text[k + 1]] == size).all()
