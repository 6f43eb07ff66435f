"""The operators against brute force, on small tables with nulls, empty and long texts, ties and
repeated rows, empty tables and columns whose names the operators use themselves."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from forgeline.llm import counts, hnsw, language, licenses, mixing, packing, quality, repair, simhash, toxicity

KINDS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, score double, id string, node string, kept string"
EN = "the house of the old man stands on the hill and the river runs below it with all its water to the sea "
DE = "das haus des alten mannes steht auf dem berg und der fluss zieht unten mit seinem ganzen wasser zum meer "
LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(30_000))


def rows():
    texts = [None, "", " \n ", "one", EN * 4, EN * 4, EN * 4 + "end", DE * 4, LONG, "%%% ### " * 60, "idiot " * 5 + EN, "A\nb\nA\nb " * 30]
    texts += [f"{EN}{i} {DE if i % 2 else EN}{i * 7}" for i in range(30)]
    out = [(i, t, "de" if t and t.startswith("das") else "en", f"s{i % 3}" if i % 7 else None, 0, "r", 0.5, "i", "n", "k") for i, t in enumerate(texts)]
    out += [out[4], out[4], (None, None, None, None, None, None, None, None, None, None), (None, EN, None, None, 1, None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), KINDS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KINDS)


@pytest.fixture(scope="module")
def labels(spark):
    kinds = "doc_id bigint, quality int, toxic int"
    known = [(i, int(not (t or "").startswith("%%%")), int("idiot" in (t or ""))) for i, t, *_ in rows() if i is not None]
    return spark.createDataFrame([*known, (None, 1, 1), (3, None, None)], kinds)


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_simhash(docs, none):
    got = simhash.op2(docs).collect()
    want = {i: brute_print(t) for i, t, *_ in rows() if i is not None and t != LONG}
    assert len(got) == len(rows())
    for r in got:
        if r.doc_id in want:
            assert int(r.fingerprint, 16) == want[r.doc_id]
    prints = {int(r.fingerprint, 16) for r in got}
    root = {p: p for p in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 2:
                    root[a] = min(root[a], root[b])
    least = {}
    for r in got:
        key = root[int(r.fingerprint, 16)]
        least[key] = min(x for x in (least.get(key), r.doc_id) if x is not None) if r.doc_id is not None else least.get(key)
    assert all(r.component_id == least[root[int(r.fingerprint, 16)]] for r in got)
    assert simhash.op2(none).count() == 0


def test_dense_links_join_what_pairs_would(spark):
    prints = [5 ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]
    got = simhash.components(simhash._named(simhash._dense_links(spark.createDataFrame([(p,) for p in prints], "a0 bigint")), simhash.THREE_WORDS))
    assert got.select("root").distinct().count() == 1 and got.count() == len(prints)


def test_large_buckets_keep_one_leader_per_group():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**62, (3, 2))
    prints = np.concatenate([c ^ (1 << rng.integers(0, 60, (50, 1))) for c in centres])
    stay, a, b = simhash._reduced(np.zeros(150, np.int64), prints, 10)
    assert len(stay) == 3 and len(a) == 147 and all(x // 50 == y // 50 for x, y in zip(a, b))


def test_probes_do_not_depend_on_partitions(spark):
    """The buckets of a family are the same however its rows are dealt out."""
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 2**62, (1, 2)) ^ (1 << rng.integers(0, 60, (200, 2)))
    rows = [([*map(int, p), k][: simhash.FIVE_WORDS.width], bytes(range(128))) for k, p in enumerate(prints)]
    classes = spark.createDataFrame(rows, "w array<bigint>, margin binary")
    chosen = simhash.Plan(tuple(tuple(range(32 * k, 32 * k + 32)) for k in range(4)), (5,) * 4)
    once, often = (sorted(map(str, simhash._probe(classes.repartition(n), simhash.FIVE_WORDS, chosen).collect())) for n in (1, 7))
    assert once == often and len(once) == 200 * 4 * 32


def shingles(text):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def relatives():
    """Sixty relatives at similarity 0.7 or so, each with a copy of similarity over 0.9."""
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 5000, 600)]
    texts = []
    for k in range(60):
        text = list(base)
        for i, at in enumerate(rng.choice(600, 11, replace=False)):
            text[at] = f"own{k}x{i}"
        at = int(rng.integers(0, 590))
        texts += [text, [*text[:at], f"new{k}", *text[at + 1 :]]]
    return [" ".join(t) for t in texts]


def test_copies_among_relatives_are_found(spark, monkeypatch):
    """Every pair of a large bucket counts, however its links to the leaders were verified."""
    texts = relatives()
    sets = [shingles(t) for t in texts]
    pairs = [(a, b, jaccard(sets[a], sets[b])) for a in range(len(texts)) for b in range(a)]
    assert 0.6 < np.median([j for *_, j in pairs]) < 0.75
    monkeypatch.setattr(simhash, "plan", lambda classes, how: simhash.Plan(((0,), (1,)), (1, 1)))  # all meet in all buckets
    for parts in (1, 6):
        rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(parts)
        got = {r.id: r.component_id for r in simhash.grouped(rows, simhash.FIVE_WORDS).select("component_id", "id").collect()}
        assert all(got[a] == got[b] for a, b, j in pairs if j >= 0.9)


def test_near_copies_are_verified_on_their_shingles(spark, monkeypatch):
    """Components are those of brute force, for similarities on both sides of 0.8, for texts of equal
    fingerprints but different shingles, and where a bucket goes over many batches and blocks."""
    texts = relatives()[:60]
    for k in range(120):
        text = [f"t{k}y{i}" for i in range(400)]
        changed, lost = list(text), 30 + k % 24
        changed[200 : 200 + lost] = [f"u{k}y{i}" for i in range(lost)]  # similarity 0.85 to 0.75
        texts += [" ".join(text), " ".join(changed)]
    line = "one line that comes again and again in it "
    texts += [line * 500 + " ".join(f"{n}{i}" for i in range(12)) for n in "pq"]
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if jaccard(sets[a], sets[b]) >= 0.8:
                root = [root[b] if r == root[a] else r for r in root]
    monkeypatch.setattr(simhash, "plan", lambda classes, how: simhash.Plan(((0,), (1,)), (1, 1)))
    monkeypatch.setattr(simhash, "HELD", 100)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = simhash.grouped(rows, simhash.FIVE_WORDS).select("component_id", "id").collect()
    parts = lambda root: {frozenset(i for i, r in root.items() if r == c) for c in set(root.values())}
    assert parts({r.id: r.component_id for r in got}) == parts(dict(enumerate(root)))


def test_a_family_of_near_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Texts each copied from an earlier one with a few words changed: the pairs compared follow the texts."""
    rng = np.random.default_rng(9)
    family = [[f"w{x}" for x in rng.integers(0, 5000, 500)]]
    for k in range(1, 240):
        text = list(family[int(rng.integers(len(family)))])
        for at in rng.choice(500, int(rng.integers(1, 3)), replace=False):
            text[at] = f"own{k}x{at}"
        family.append(text)
    sets = [shingles(" ".join(t)) for t in family]
    pairs = [(a, b) for a in range(240) for b in range(a) if jaccard(sets[a], sets[b]) >= 0.8]
    assert len(pairs) > 10 * 240
    compared, exact = [], simhash._exact
    monkeypatch.setattr(simhash, "_exact", lambda pairs, texts, how: compared.append(pairs.count()) or exact(pairs, texts, how))
    monkeypatch.setattr(simhash, "plan", lambda classes, how: simhash.Plan(((0,), (1,)), (1, 1)))
    monkeypatch.setattr(simhash, "PAIRWISE", 400)  # all links of a bucket come out of it
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(family)], "doc_id bigint, text string")
    got = {r.id: r.component_id for r in simhash.grouped(rows, simhash.FIVE_WORDS).select("component_id", "id").collect()}
    assert all(got[a] == got[b] for a, b in pairs)
    assert sum(compared) < 12 * 240  # of over 24,000 whose sketches are alike


def test_unlike_texts_differ_in_their_signs():
    texts = [" ".join(t) for t in np.random.default_rng(4).choice([f"w{k}" for k in range(200)], (60, 120))]
    changed = [t.split()[:-8] + ["x"] * 8 for t in texts]
    prints, near = (np.array([simhash._print_of(t, simhash.FIVE_WORDS)[0] for t in part]) for part in (texts, [" ".join(c) for c in changed]))
    assert all(simhash._close(prints[k : k + 1], near[k : k + 1], 128, 2)[0] for k in range(60))
    unlike = np.concatenate([simhash._close(prints[k + 1 :], prints[k : k + 1], 128, 2) for k in range(59)])
    assert unlike.mean() < 0.12


def test_texts_are_not_moved_to_be_judged_or_deduplicated(spark, docs):
    """Only numbers are joined to labels, and only numbers are gathered by component."""
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(8)], "doc_id bigint, quality int, toxic int")
    for rows in (quality.good_documents(docs, labels), simhash.distinct_documents(docs)):
        assert "Exchange hashpartitioning(component" not in rows._jdf.queryExecution().toString()
        assert "Aggregate" not in rows._jdf.queryExecution().toString()


def test_allocation_is_the_cheapest():
    costs = [[0.0, 4.0, 9.0], [0.0, 1.0, 2.0], [0.0, 5.0, 5.5]]
    assert simhash.allocate(costs, 3)[1] == min(a + b + c for i, a in enumerate(costs[0]) for j, b in enumerate(costs[1]) for k, c in enumerate(costs[2]) if i + j + k >= 3)


def test_distinct_documents(docs, none):
    kept = simhash.distinct_documents(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 1 and 5 not in ids and 6 not in ids and 8 in ids
    assert simhash.distinct_documents(none).count() == 0


def test_mix(docs, none):
    got = mixing.mix(docs).select("source", "size", "source_size", "target", "taken", F.col("row.text").alias("text")).collect()
    assert len(got) == len(rows())
    assert all(r.size == len((r.text or "").encode().split()) and 0 <= r.taken <= 2 * r.size for r in got)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r.size for r in own) == own[0].source_size
        assert own[0].target - len(own) <= sum(r.taken for r in own) <= own[0].target
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(5)).select("source", "size", "source_size", "target", "taken", F.col("row.text").alias("text")).collect()), key=str)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(len(r.text.encode().split()) for r in out.collect()) == sum(r.taken for r in got)
    assert mixing.op5(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def brute_repeats(words):
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {g for g in grams if grams.count(g) > 1} if len(grams) < 2000 else {g for g, n in __import__("collections").Counter(grams).items() if n > 1}
    return len({j for i, g in enumerate(grams) if g in often for j in range(i, i + 3)})


def test_quality(docs, none, labels):
    got = quality.judged(docs, labels).select(F.col("row.text").alias("text"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert len(got) == len(rows())
    for r in got:
        words = (r.text or "").split()
        lines = [x for x in (r.text or "").split("\n") if x.split()]
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "") and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == brute_repeats(words)
        assert r.base_failed == (len(words) < 50 or 100 * r.n_repeat_words > 50 * len(words))
        assert not (r.base_failed and r.kept)
    assert quality.good_documents(docs, labels).columns == docs.columns
    assert quality.good_documents(none, labels).count() == 0
    assert quality.good_documents(docs, labels.limit(0)).count() == sum(not r.base_failed for r in got)


def test_learned_rule(spark):
    texts = [(i, " ".join(f"w{(i * 31 + j * j) % 701}{'%%' if i % 4 == 0 else ''}" for j in range(80))) for i in range(160)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 != 0).cast("int").alias("quality"))
    ids = {r.doc_id for r in quality.good_documents(docs, labels).collect()}
    assert ids == {i for i, _ in texts if i % 4}


def test_language(docs, none):
    got = language.op9(docs).collect()
    assert len(got) == len(rows())
    assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2, 9)} == {"und"}
    assert all(r.lang_pred == "en" for r in got if r.doc_id in (4, 5, 6)) and all(0 <= r.score <= 1 for r in got)
    assert language.understood_documents(docs).columns == docs.columns
    assert language.op9(none).count() == 0
    assert {r.lang_pred for r in language.op9(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_toxicity(docs, none, labels):
    ids = docs.sparkSession.range(100, 500)
    body = F.concat(F.lit(EN), F.when(F.col("id") % 5 == 0, " idiot moron idiot ").otherwise(" calm "), F.lit(EN))
    more = ids.select(F.col("id").alias("doc_id"), body.alias("text"))
    known = labels.unionByName(ids.select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") % 5 == 0).cast("int").alias("toxic")))
    model = toxicity.learn(more, known, teach=F.col("id") % 4 != 2)
    got = toxicity.scored(more, model, keep_rows=False).where("id >= 100").collect()
    assert all(r.predicted == int(r.id % 5 == 0) for r in got)
    assert {r.id: r.predicted for r in toxicity.scored(docs, model, keep_rows=False).collect() if r.id in (0, 1, 4, 10)} == {0: 0, 1: 0, 4: 0, 10: 1}
    assert toxicity.scored(docs, None).select("score").distinct().collect() == [(0.0,)]
    assert toxicity.learn(none, labels) is None


def test_segments_are_all_maximal_ones():
    rng = np.random.default_rng(3)
    for _ in range(200):
        scores = np.where(rng.random(14) < 0.4, rng.integers(1, 6, 14), -1.0)

        def brute(a, b):
            """Ruzzo and Tompa by definition: the best piece, then the same left and right of it."""
            pieces = [(scores[i:j].sum(), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
            if not pieces or max(pieces)[0] <= 0:
                return []
            _, _, _, i, j = max(pieces)
            return brute(a, i) + [(i, j, float(scores[i:j].sum()))] + brute(j, b)

        scored = [(i, float(s)) for i, s in enumerate(scores) if s > 0]
        got = toxicity.segments(scored, 14, -1.0)
        assert sum(s for *_, s in got) == sum(s for *_, s in brute(0, 14)) or [round(s) for *_, s in got] == [round(s) for *_, s in brute(0, 14)]


def test_token_counts(docs, none):
    model = counts.unigram(counts.vocabulary_path())
    got = counts.counted(docs, counts.vocabulary_path()).select(F.col("row.text").alias("t"), "n_tokens").collect()
    assert len(got) == len(rows())
    for r in got:
        if r.t != LONG:
            assert r.n_tokens == sum(model.count_one(counts.START + w) for w in (r.t or "").split())
    assert counts.op4(none).count() == 0


def test_token_counts_agree_with_a_viterbi_encoder():
    from tokenizers import Tokenizer, models

    model = counts.unigram(counts.vocabulary_path())
    encoder = Tokenizer(models.Unigram([("<unk>", -100.0), *model.pieces.items()], 0, False))
    for word in (EN + DE).split():
        assert len(encoder.encode(counts.START + word).ids) == model.count_one(counts.START + word)


def encoded(path, text, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def test_token_files(docs, none):
    got = sorted(repair.op7(docs).collect(), key=lambda r: (r.doc_id is not None, r.doc_id, r.start))
    at = 0
    texts = {i: t for i, t, *_ in rows() if i is not None}
    assert len(got) == len(rows())
    for r in got:
        assert r.start == at
        at += r.n_tokens
        if r.doc_id is not None:
            ids = np.array(encoded(repair.tokenizer_path(), texts[r.doc_id], 1), "<u4")
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
    assert repair.op7(none).count() == 0


def test_grammar_random_access():
    ids = np.random.default_rng(2).choice([1, 2, 3, 3, 3, 70], 5000)
    made = repair.compress(ids, 100)
    assert len(made.symbols) < 3000 and (made.expand(made.symbols) == ids).all()
    for start, end in ((0, 1), (17, 90), (4990, 5000), (0, 5000), (300, 300)):
        assert (made.slice(start, end) == ids[start:end]).all()
    for few in ([], [4], [4] * 9):
        made = repair.compress(np.array(few, np.int64), 100)
        assert made.expand(made.symbols).tolist() == few


@pytest.mark.parametrize("text", ["a  b", "a \n b\n\nc ", " x\t\ty", "it's 12,5%", "a b c", "\x1c a", "naïve  ÉTÉ\r\nx", "", "a\n"])
@pytest.mark.parametrize("path", [packing.tokenizer_path(), repair.tokenizer_path()])
def test_encoding_by_chunks(path, text):
    from forgeline.llm.tokens import encoder

    assert encoder(path)(text).tolist() == encoded(path, text, 0)[:-1]


def test_packing(docs, none):
    got = packing.pack(docs, packing.tokenizer_path()).collect()
    texts = {i: t for i, t, *_ in rows() if i is not None}
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024 and at & (at - 1) == 0
    for i in set(texts) - {4}:
        pieces = sorted((r.start, bytes(r.ids)) for r in got if r.doc_id == i)
        assert np.frombuffer(b"".join(p for _, p in pieces), "<u4").tolist() == encoded(packing.tokenizer_path(), texts[i], 0)
    assert packing.op8(none).count() == 0


def test_new_words_of_many_texts_are_encoded_together(monkeypatch):
    """Texts encoded together have the ids each has alone, at a few calls of the tokenizer for all of them."""
    from forgeline.llm.tokens import Encoder

    rng = np.random.default_rng(11)
    gaps = [" ", " ", " ", "  ", "\n", " \n", "\n ", "\t", "\r\n", "   ", "\n\n "]
    texts = ["", " ", "\n", "  a", "a  ", " \n ", "müde – 漢字 don't", "odd gap", "fi\x1cle", "x" * 50]
    for _ in range(200):
        words = ["".join(chr(c) for c in rng.choice([97, 101, 116, 233, 39, 44, 8364, 0x1F600], 4)) for _ in range(20)]
        texts.append("".join(w + gaps[int(rng.integers(len(gaps)))] for w in words))
    for path in (packing.tokenizer_path(), repair.tokenizer_path()):
        encoder, calls = Encoder(path), []
        together = encoder._together
        monkeypatch.setattr(encoder, "_together", lambda words: calls.append(len(words)) or together(words))
        got = list(encoder.column(pa.array([*texts, None])))
        assert [g.tolist() for g in got] == [encoded(path, t, 0)[:-1] for t in [*texts, None]]
        assert max(calls) > 500 and len(calls) < len(texts)


def test_packing_computes_the_curve_once(spark, docs, monkeypatch):
    """Ranges of the curve come from some of the documents; all are packed, copies in several ranges."""
    assert "rangepartitioning" not in packing.pack(docs, packing.tokenizer_path())._jdf.queryExecution().toString()
    rows = spark.createDataFrame([(k, "the same words again and again") for k in range(4000)], "doc_id bigint, text string")
    ranged = packing._ranged(rows.withColumnRenamed("doc_id", "id"))
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) >= 4 and max(sizes) < 2 * 4000 / 8


def test_hilbert_visits_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    order = np.argsort(packing.hilbert(grid, 3))
    assert (np.abs(np.diff(grid[order], axis=0)).sum(1) == 1).all()


def test_licenses(spark, docs, none):
    header = licenses.TEMPLATES["GPL-3.0 header"]
    texts = [EN + "Released under the MIT License. " + EN, header.replace("free software:", "free, good software:"), "licensed", None, ""]
    got = licenses.op10(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    found = {(r.doc_id, r.license): r for r in got}
    assert set(found) == {(0, "MIT"), (1, "GPL-3.0 header")}
    r = found[0, "MIT"]
    assert texts[0][r.start : r.end] == "Released under the MIT License" and r.coverage == 1
    assert found[1, "GPL-3.0 header"].coverage > 0.9
    assert licenses.op10(docs).count() == 0 and licenses.op10(none).count() == 0


def test_license_lines_that_stand_close_together():
    """Every notice is reported, however few words lie between it and the one before."""
    known = licenses.index(licenses.TEMPLATES)
    for name in ("MIT", "CC-BY-NC-4.0", "Apache-2.0", "GPL-3.0"):
        line = licenses.TEMPLATES[name]
        for gap in ("", "and ", "one two three four five six seven eight nine ten "):
            for times in (1, 2, 3, 7):
                text = f"{gap}{line} " * times + "the end"
                got = licenses.find(text, known, licenses.Scan())
                starts = [k for k in range(len(text)) if text.startswith(line, k)]
                assert [(m["license"], m["start"], m["coverage"]) for m in got] == [(name, k, 1) for k in starts]
    cut = "Released under the MIT. Released under the MIT License."
    assert [m["matched_words"] for m in licenses.find(cut, known, licenses.Scan())] == [4, 5]


def test_nearest(spark):
    rng = np.random.default_rng(5)
    points = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 16)) * rng.random((600, 1)))]
    points += [(1000 + i, points[7][1]) for i in range(40)]
    odd = [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] + [1.0] * 15), (2060, [None] + [1.0] * 15), (2080, []), (None, [1.0] * 16)]
    frame = spark.createDataFrame(points + odd, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x"))
    got = hnsw.op1(frame).collect()
    ids, x = np.array([i for i, _ in points]), np.array([v for _, v in points])
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        want = ids[np.lexsort((ids, -np.round(scores, 9)))[:20]]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21)) and all(a.score >= b.score for a, b in zip(own, own[1:]))
        hits, total = hits + len(set(want) & {r.vec_id for r in own}), total + 20
    assert hits / total >= 0.9 and {r.query_id for r in got} == {int(q) for q in ids if q % 20 == 0}
    assert hnsw.op1(frame.limit(0)).count() == 0
    assert hnsw.op1(spark.createDataFrame(points[:3], "vec_id bigint, embedding array<double>")).count() == 2


def vectors_of(kind):
    rng = np.random.default_rng(11)
    n, d = 2400, 24
    points = rng.standard_normal((n, d))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    if kind == "clusters":
        centres = points[:40] * np.exp(0.5 * rng.standard_normal((40, 1)))
        return centres[rng.integers(0, 40, n)] + 0.02 * rng.standard_normal((n, d))
    return points * np.exp(kind * rng.standard_normal((n, 1)))


@pytest.mark.parametrize("kind", [0, 0.1, 0.25, 1.0, "clusters", "huge"])
def test_recall_whatever_the_lengths(spark, kind):
    x = vectors_of(0.25) * 1e200 if kind == "huge" else vectors_of(kind)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {}
    # Small shards, so that bands are cut and beams are narrower than what they search.
    for r in hnsw.nearest(frame, F.col("vec_id") % 20 == 0, 20, hnsw.Graphs(shard=1000)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for q in range(0, len(x), 20):
        scores = (x / np.abs(x).max()) @ (x[q] / np.abs(x).max())
        scores[q] = -np.inf
        recall.append(len(got[q] & set(np.argsort(-scores)[:20].tolist())) / 20)
    if kind == "huge":  # products beyond what a double holds are all infinite: ties
        assert all(len(found) == 20 for found in got.values())
    else:
        assert np.mean(recall) >= 0.95 and min(recall) >= 0.6


def test_shards_of_bands():
    how = hnsw.Graphs(shard=100, beam=10)
    places = hnsw._placed([(5, 3), (4, 4), (3, 250), (2, 3), (1, 3), (-9, 5)], how)
    # The two longest bands share a shard; one of 250 is cut in three; what fits the beam is put together again.
    assert places == [(5, 0, 1), (4, 0, 1), (3, 1, 3), (2, 4, 1), (1, 4, 1), (-9, 5, 1)]
    assert hnsw._placed([], how) == []


def test_bands_of_lengths(spark):
    sizes = [1.0, 0.99, 1.04, 1.06, 2.0, 1e-300, 1e300, 5e-324]
    frame = spark.createDataFrame([([0.6 * x, 0.8 * x],) for x in sizes[:-1]] + [([0.0, sizes[-1]],)], "v array<double>")
    got = [r.b for r in frame.select(hnsw._band(F.col("v"), 1.1).alias("b")).collect()]
    assert got == [int(np.floor(np.log(x) / np.log(1.1) + 0.5)) for x in sizes]
    assert got[:4] == [0, 0, 0, 1]


def test_pipeline(spark, tmp_path, docs, labels):
    import corpus_pipeline

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "language id", "simhash near-dedup", "source mix", "packing"]
    stage = docs
    for _, function in corpus_pipeline.STAGES[:-1]:
        stage = function(spark, stage, str(tmp_path))
        assert stage.columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
