"""The trie, the alignment and the removal of repeated passages against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from forgeline.llm import alignment, prefixes, substrings

DOC = "doc_id bigint, text string, row string, id string, t string, place int, score double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def doc_rows(texts):
    return [(i, t, "r", "i", "t", 1, 0.5) for i, t in texts]


# -- passages ----------------------------------------------------------------------------------------


def removed(texts, window):
    """One window at a time, in the order of id; rows equal in id and text are one document."""
    seen, out = set(), {}
    for i, text in sorted(set(texts), key=lambda x: (x[0] is None, x[0] or 0, x[1] or "")):
        words = WORD.findall(text or "")
        covered = set()
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if key in seen:
                covered.update(range(at, at + window))
            seen.add(key)
        kept = " ".join(w for k, w in enumerate(words) if k not in covered)
        out[i, text] = (len(words), len(covered), hashlib.sha256(kept.encode()).hexdigest())
    return out


def passage_texts():
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(300)}"
    passages = [[word() for _ in range(n)] for n in (19, 20, 21, 60)]
    texts = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "same " * 70), (5, "x y " * 40)]
    for k in range(6, 60):
        words = [f"own{k}x{i}" for i in range(rng.randrange(5, 30))]
        for p in rng.sample(passages, rng.randrange(0, 4)):
            words += p + [word() for _ in range(rng.randrange(0, 4))]
        texts.append((k, rng.choice([" ", "\n", "  ", "\x0b"]).join(words)))
    texts += [(70, texts[20][1]), (71, texts[20][1]), (72, texts[4][1]), (72, texts[4][1]), (73, "é ü " * 30 + " ")]
    texts.append((80, " ".join(f"long{i % 9000}" for i in range(20_000))))
    return texts


@pytest.mark.parametrize("shortest", [5, 10])
def test_passages_that_start_earlier_are_removed(spark, shortest):
    texts = passage_texts() + [(None, " ".join(f"own6x{i}" for i in range(25)))]
    want = removed(texts, 20)
    for parts in (1, 5):
        rows = spark.createDataFrame(doc_rows(texts), DOC).repartition(parts)
        got = substrings.deduplicated(rows, shortest=shortest).collect()
        assert len(got) == len(texts)
        assert Counter((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == Counter((i, *want[i, t]) for i, t in texts)


def test_passages_of_texts_that_share_an_id(spark):
    """Each word of all texts of an id but one is removed when they share a passage; an empty table gives no rows."""
    shared = " ".join(f"a{i}" for i in range(30))
    rows = spark.createDataFrame(doc_rows([(1, shared + " b"), (1, shared + " c"), (1, shared + " c")]), DOC)
    got = sorted((r.n_words, r.n_removed) for r in substrings.op13(rows).collect())
    assert got in ([(31, 0), (31, 30), (31, 30)], [(31, 0), (31, 0), (31, 30)])
    assert substrings.op13(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        substrings.deduplicated(rows, 20, 3)


def test_sampled_windows_cover_every_window():
    texts = [t.encode() for _, t in passage_texts() if t]
    words = substrings.Words(texts)
    at, _ = words.sampled(5, 20)
    for start in words.windows(20):
        assert ((at >= start) & (at <= start + 15)).any()


# -- alignment -----------------------------------------------------------------------------------------


def test_merge_path_finds_all_common_ends():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 400):
        a, b = (np.unique(rng.integers(0, 3 * n + 1, n)) for _ in range(2))
        for work in (1, 2, 7, 1000):
            i, j = alignment.ends_together(a, b, work)
            assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
    a, b = np.arange(50), np.arange(0, 50, 3)
    cut = alignment.crossings(a, b, np.arange(len(a) + len(b) + 1))
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    assert cut.tolist() == [sum(side == 0 for _, side in merged[:d]) for d in range(len(merged) + 1)]


def brute_alignment(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_path, b_path = alignment.tokenizer_paths()
    ours, theirs = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
    ours.encode_special_tokens = True
    both = alignment.pair(a_path, b_path)
    out, counts = [], Counter()
    for text in texts:
        a = ours.encode(" " + text, add_special_tokens=False).ids if text else []
        b = theirs.encode(text) if text else []
        spelled = [[both.a_bytes[i] for i in a], [both.b_bytes[i] for i in b]]
        if not text or any(b"".join(s) != (" " + text).encode() for s in spelled):
            out.append(None)
            continue
        ends = [dict(zip(np.cumsum([len(x) for x in s]).tolist(), ids)) for s, ids in zip(spelled, (a, b))]
        groups, links, left, right = [], [], [], []
        for end in sorted({*ends[0], *ends[1]}):
            left += [ends[0][end]] if end in ends[0] else []
            right += [ends[1][end]] if end in ends[1] else []
            if end in ends[0] and end in ends[1]:
                links.append((ends[0][end], ends[1][end]))
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
        counts.update(links)
        out.append((len(a), len(b), links, ";".join(groups)))
    return out, counts


ODD_TEXTS = [
    None, "", " ", "  two  spaces ", "a\n\nb\r\nc\td", "<|endoftext|> and <s> </s> <unk> <0x41>", "naïve ﬁ ½ 日本語 é", "a▁b",
    "x y　z", "it's we'll I'D", "12345 67,89", "\x00\x01", "tail \n", "\n head", "é 🙂🙂", "the house " * 400,
    "a;\r\nb){\r", "\x85 next", "ab " * 3 + "\x1c",
]


@pytest.mark.parametrize("head", [3, alignment.HEAD])
def test_alignment(spark, head):
    """Groups, links and counts, with the rarer pairs looked up by join or all from the head."""
    texts = [*ODD_TEXTS, "the house", "the house"]
    want, counts = brute_alignment(texts)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    assert want[ODD_TEXTS.index("a▁b")] is None and want[3] is not None
    rows = [(None if k == 3 else 7 if k in (4, 5) else k, t, "r", "i", "t", 1, 0.5) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    paths = alignment.tokenizer_paths()
    both = alignment.pair(*paths)
    from forgeline.session import materialize

    stored = materialize(alignment.aligned(docs, *paths, with_groups=True), "aligned")
    got = alignment.with_counts(stored, both.pair_kind, both.shift, head).collect()
    expected = []
    for (i, *_), row in zip(rows, want):
        if row is None:
            expected.append((i, 0, 0, 0, "", "", 0, 0))
            continue
        n_a, n_b, links, groups = row
        sha = hashlib.sha256(groups.encode()).hexdigest()
        expected.append((i, n_a, n_b, len(links), sha, groups, sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links)))
    found = [(r.id, r.n_a, r.n_b, r.n_links, r.groups_sha256, r.groups, r.n_best, r.count_sum) for r in got]
    assert Counter(found) == Counter(expected)


def test_alignment_of_an_empty_table_and_a_full_memory(spark):
    docs = spark.createDataFrame(doc_rows([(1, "the house of the man")]), DOC)
    assert alignment.op12(docs.limit(0)).count() == 0
    paths = alignment.tokenizer_paths()
    small = alignment.Pair(*paths, remembered=2)
    for text in ("the house of the man", "one two three four", "the house of the man", "one more house"):
        assert small.ids(text) == alignment.pair(*paths).ids(text)


# -- trie ------------------------------------------------------------------------------------------------


def brute_trie(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns.setdefault(conv, []).append(((turn is not None, turn or 0), key, (role, text)))
    turns = {c: [t for *_, t in sorted(v)] for c, v in turns.items()}
    seqs = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        start = c - int(np.fmod(c, 5))
        seqs[c] = tuple(turns.get(start, [])[:h] + own[h:])
    members = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    nodes = {}
    for seq in sorted(members, key=len, reverse=True):
        below = [s for s in members if len(s) == len(seq) + 1 and s[:-1] == seq]
        ends = sorted(c for c in members[seq] if len(seqs[c]) == len(seq))
        size = len(seq[-1][1].encode()) if seq else 0
        leaves = sum(nodes[s][5] for s in below) or 1
        saved = sum(nodes[s][6] for s in below) + (len(members[seq]) - 1) * size
        parent = min(members[seq[:-1]]) if seq else None
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        nodes[seq] = (min(members[seq]), len(seq), parent, len(members[seq]), len(below), leaves, saved, sha)
    return sorted(nodes.values(), key=str)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-7, 60), 101, 103]:
        if c in (10, 25):
            continue  # a group without the one that starts it
        shared = rng.random() < 0.6
        for turn in range(rng.choice([1, 2, 3, 5, 12])):
            text = f"t{turn}" if shared else rng.choice(["a", "b", "é", None])
            rows.append((c, None if turn == 0 and c % 3 == 0 else turn, rng.choice(["user", "bot", None]) if not shared else "user", text))
    rows += [(3, 1, "user", "tie"), (3, 1, "user", "tie"), (3, 1, "bot", "tie"), (None, 0, "user", "lost")]
    return rows


@pytest.mark.parametrize("limits", [(4096, 1 << 17), (4, 1 << 17), (1, 1), (100, 8)])
def test_trie(spark, limits):
    rows = conversations(sum(limits))
    table = spark.createDataFrame([(*r, "k", 1, None) for r in rows], "conv_id bigint, turn bigint, role string, text string, key string, n int, path string")
    got = prefixes.prefix_trie(prefixes.rebuilt(prefixes.sequences(table.repartition(4))), *limits).collect()
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == brute_trie(rows)


def test_trie_of_many_copies_and_of_nothing(spark, monkeypatch):
    """The ids of many copies are hashed from several blocks."""
    monkeypatch.setattr(prefixes, "BLOCK", 400)
    rows = [(c, t, "user", f"t{t}") for c in range(300) for t in range(12)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.depth: r for r in prefixes.op11(table).collect()}
    assert len(got) == 13 and got[12].n_convs == 300 and got[0].n_leaves == 1
    assert got[12].ends_sha256 == hashlib.sha256(",".join(map(str, range(300))).encode()).hexdigest()
    assert prefixes.op11(table.limit(0)).count() == 0
