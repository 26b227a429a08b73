"""SimHash, line and substring deduplication against brute force."""

import os
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from civiq.llm import components, linededup, simhash, substrings
from tests.llm.conftest import LONG, ODD


def words_of(text):
    return (text or "").encode().split()


def test_fingerprint_counts_every_shingle():
    import xxhash

    text = "A b c a B c d"
    shingles = ["a b c", "b c a", "c a b", "a b c", "b c d"]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    want = sum(1 << i for i in range(64) if 2 * sum(v >> i & 1 for v in values) > len(values))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("x Y") == xxhash.xxh64_intdigest("x y", 42)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def groups(fps, distance=3):
    left, out = set(fps), {}
    while left:
        queue = [min(left)]
        group = set(queue)
        left -= group
        while queue:
            at = queue.pop()
            near = {f for f in left if bin(f ^ at).count("1") <= distance}
            left -= near
            group |= near
            queue += near
        out |= {f: min(group) for f in group}
    return out


@pytest.mark.parametrize("block", [2048, 3])
def test_links_have_the_components_of_all_links(llm, monkeypatch, block):
    monkeypatch.setattr(simhash, "_BLOCK", block)
    r = random.Random(5)
    fps = set()
    for _ in range(12):
        at = r.getrandbits(63)
        for _ in range(25):
            at ^= sum(1 << b for b in r.sample(range(63), r.choice([0, 1, 2, 3, 4])))
            fps.add(at)
    found = components.connected_components(simhash.links(llm.createDataFrame([(f,) for f in fps], "fp long")))
    got = {row["node"]: row["component"] for row in found.collect()}
    want = groups(fps)
    assert {f: got.get(f, f) for f in fps} == want
    assert len(got) > 50


def test_components_of_chains_stars_and_loops(llm):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (200, 201), (201, 200)]
    found = {r["node"]: r["component"] for r in components.connected_components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100), 200: 200, 201: 200}


def test_near_duplicates_of_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add(r["component"])
    assert by_id[8] == {7} and by_id[10] == {9} and by_id[2] == {2} and by_id[5] == {3} and by_id[4] == {3}
    assert simhash.near_duplicates(none).count() == 0


def test_one_row_of_a_group_stays(odd, none):
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda v: (v is None, v))
    assert ids == [1, 2, 3, 6, 7, 9, 11, None]
    assert simhash.keep_first(none).count() == 0


def shingle_texts(text, words=5):
    tokens = (text or "").lower().split()
    return {" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))} if tokens else set()


def brute_components(texts, words=5):
    """Text number to the least number reachable over pairs with a Jaccard similarity of 0.8 or more."""
    sets, root = [shingle_texts(t, words) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and (similar(sets[i], sets[j]) or not sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def near_copies(seed=17):
    """Texts of 8 to 400 words with copies that differ in a few words, many at 0.8 to 0.95 of their shingles."""
    r = random.Random(seed)
    vocabulary, texts = [f"w{i}" for i in range(900)], []
    for _ in range(25):
        base = [r.choice(vocabulary) for _ in range(r.choice([8, 20, 60, 150, 400]))]
        texts.append(" ".join(base))
        for _ in range(r.randint(0, 6)):
            other = list(base)
            for _ in range(r.randint(1, max(1, len(base) // 35))):
                other[r.randrange(len(base))] = r.choice(vocabulary)
            texts.append(" ".join(other) + r.choice(["", " w1", " w2 w3"]))
    r.shuffle(texts)
    return texts


def test_near_copies_down_to_the_similarity_go(make):
    texts = near_copies()
    sets = [shingle_texts(t) for t in texts]
    low = sum(0.8 <= len(a & b) / len(a | b) < 0.95 for i, a in enumerate(sets) for b in sets[:i])
    kept = sorted(r["doc_id"] for r in simhash.keep_first(make([(i, t, "en") for i, t in enumerate(texts)])).collect())
    root = brute_components(texts)
    assert kept == sorted(set(root)) and low > 20 and len(kept) < len(texts) - 20


def test_near_copies_leave_little_behind(make, monkeypatch):
    stored, kept = [], simhash.materialize

    def noted(rows, label):
        stored.append((label, kept(rows, label)))
        return stored[-1][1]

    for module in (simhash, simhash.shingles, components):
        monkeypatch.setattr(module, "materialize", noted)
    texts = near_copies()
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    found = sorted(row["doc_id"] for row in simhash.keep_first(make([*rows, *rows[:30], (None, texts[0], "en")])).collect())
    assert found == sorted(set(brute_components(texts)))
    left = {label for label, rows in stored if os.path.exists(rows.scratch_path.removeprefix("file://"))}
    assert left <= {"first", "buckets", "components"} and len(stored) > 10


def test_near_copies_are_found_by_linked_fingerprints(make, monkeypatch):
    r, real = random.Random(29), simhash.shingles._prefixes
    base = [f"w{r.randrange(900)}" for _ in range(400)]
    other = " ".join(["new", *base[1:]])
    assert bin(simhash.fingerprint(" ".join(base), 5) ^ simhash.fingerprint(other, 5)).count("1") <= 3
    docs = make([(1, " ".join(base), "en"), (2, other, "en"), (3, " ".join(reversed(base)), "en"), (4, "far from it", "en")])
    # Without a shared shingle to meet by, only fingerprints are left.
    monkeypatch.setattr(simhash.shingles, "_prefixes", lambda *given: real(*given).where("node is null"))
    assert sorted(row["doc_id"] for row in simhash.keep_first(docs).collect()) == [1, 3, 4]
    # A link of fingerprints alone drops nothing.
    monkeypatch.setattr(simhash, "met_links", lambda fps, distance: fps.select(F.col("fp").alias("a")).crossJoin(
        fps.select(F.col("fp").alias("b"))).where("a < b"))
    assert sorted(row["doc_id"] for row in simhash.keep_first(docs).collect()) == [1, 3, 4]


def similar(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def brute_lines(rows):
    order = sorted({(i is None, i or 0, t) for i, t, _ in rows}, key=lambda x: x[:2])
    seen, out = [], {}
    for none, number, text in order:
        gone = []
        for at, line in enumerate((text or "").translate(str.maketrans("\t\r\x0b\x0c", "    ")).split("\n")):
            words = frozenset(w for w in line.lower().split(" ") if w)
            if words and any(similar(words, s) for s in seen):
                gone.append(at)
            if words:
                seen.append(words)
        out[None if none else number, text] = gone
    return out


def test_line_dedup_agrees_with_all_pairs(make):
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)]
    lines = [[r.choice(vocabulary) for _ in range(r.randint(1, 14))] for _ in range(50)]
    rows = []
    for number in range(60):
        text = []
        for _ in range(r.randint(0, 5)):
            line = list(r.choice(lines))
            if r.random() < 0.5:
                line[r.randrange(len(line))] = r.choice(vocabulary)
            text.append(" ".join(line))
        rows.append((number, "\n".join(text), "en"))
    found = {r["id"]: r["removed"] for r in linededup.removed_lines(make(rows)).collect()}
    assert found == {i: gone for (i, _), gone in brute_lines(rows).items()}
    assert sum(map(len, found.values())) > 40


@pytest.mark.parametrize("one_document", [False, True])
def test_near_copies_of_a_line_meet_one_of_them(make, monkeypatch, one_document):
    shape = " ".join(f"common{i}" for i in range(24))
    met, kept = {}, linededup.materialize

    def counted(rows, label):
        stored = kept(rows, label)
        met.setdefault(label, []).append(stored.count())
        return stored

    monkeypatch.setattr(linededup, "materialize", counted)
    for n in (500, 1000, 2000):
        met.clear()
        lines = [f"{shape} own{i}" for i in range(n)]
        rows = [(1, "\n".join(lines), "en")] if one_document else [(i, line, "en") for i, line in enumerate(lines)]
        assert sum(len(r["removed"]) for r in linededup.removed_lines(make(rows)).collect()) == n - 1
        assert met["leaders"][0] <= n and met["open"][0] <= n // 50 and met["candidates"][0] <= n


def test_long_lines_with_a_word_in_common_are_no_candidates(make, monkeypatch):
    met, kept, r = [], linededup.materialize, random.Random(31)

    def counted(rows, label):
        stored = kept(rows, label)
        if label == "candidates":
            met.append(stored.count())
        return stored

    monkeypatch.setattr(linededup, "materialize", counted)
    vocabulary = [f"word{i:05}" for i in range(4000)]
    lines = [r.sample(vocabulary, 150) for _ in range(200)]
    rows = [(i, " ".join(line), "en") for i, line in enumerate(lines)]
    rows.append((200, " ".join([*lines[7][:145], *(f"other{i}" for i in range(5))]), "en"))
    found = {row["id"]: row["removed"] for row in linededup.removed_lines(make(rows)).collect()}
    assert found == {i: gone for (i, _), gone in brute_lines(rows).items()} and found[200] == [0]
    assert sum(met) < 100


def test_lines_do_not_meet_by_a_word_of_very_many(make, monkeypatch):
    met, kept, r = [], linededup.materialize, random.Random(37)

    def counted(rows, label):
        stored = kept(rows, label)
        if label == "candidates":
            met.append(stored.count())
        return stored

    monkeypatch.setattr(linededup, "materialize", counted)
    # What meets is counted, without the filters.
    monkeypatch.setattr(linededup, "_alike", lambda *given: F.lit(True))
    lines = [["thelongestwordofalllines", *(f"w{r.randrange(10 ** 9)}" for _ in range(19))] for _ in range(600)]
    lines.append(["other", *lines[5][:19]])
    rows = [(i, " ".join(line), "en") for i, line in enumerate(lines)]
    found = {row["id"]: row["removed"] for row in linededup.removed_lines(make(rows)).collect()}
    assert found == {i: [0] if i == 600 else [] for i in range(601)}
    assert sum(met) < 1000


@pytest.mark.parametrize("hot", [0, 3])
def test_lines_that_meet_by_two_words_agree_with_all_pairs(make, monkeypatch, hot):
    monkeypatch.setattr(linededup, "_HOT", hot)
    # Nothing is settled before.
    monkeypatch.setattr(linededup, "_leaders", lambda sets, threshold: sets.select(F.col("id").alias("l"), F.col("id").alias("e")).where("false"))
    r, vocabulary = random.Random(41), [f"w{i}" for i in range(70)]
    lines = [r.sample(vocabulary, r.randint(1, 30)) for _ in range(25)]
    rows = []
    for number in range(150):
        line = list(r.choice(lines))
        for _ in range(r.randint(0, 3)):
            line[r.randrange(len(line))] = r.choice(vocabulary)
        rows.append((number, " ".join(line[r.randint(0, 1):]), "en"))
    found = {row["id"]: row["removed"] for row in linededup.removed_lines(make(rows)).collect()}
    assert found == {i: gone for (i, _), gone in brute_lines(rows).items()}
    assert sum(map(len, found.values())) > 40


def test_line_dedup_leaves_little_behind(make, tmp_path, monkeypatch):
    stored, kept = [], linededup.materialize

    def noted(rows, label):
        stored.append(kept(rows, label))
        return stored[-1]

    monkeypatch.setattr(linededup, "materialize", noted)
    rows = [(i, f"line {i} of its own\nthe line of all documents", "en") for i in range(20)]
    assert sorted(len(row["text"].split("\n")) for row in linededup.deduplicate(make(rows)).collect()) == [1] * 19 + [2]
    left = [s for s in stored if os.path.exists(s.scratch_path.removeprefix("file://"))]
    assert len(left) == 1 and left[0].columns == ["id", "digest", "n_lines", "removed"]


def test_line_dedup_of_odd_rows(odd, none, make):
    found = {r["id"]: (r["n_lines"], r["removed"]) for r in linededup.removed_lines(odd).collect() if r["id"] is not None}
    assert found[2] == (2, [0, 1]) and found[8] == (1, [0]) and found[10] == (1, [0]) and found[3] == (1, []) and found[5] == (3, [])
    kept = linededup.deduplicate(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [1, 3, 4, 5, 6, 7, 9, 11]
    one = linededup.deduplicate(make([(1, ODD[0][1], "en"), (11, ODD[0][1] + "\nnew line", "en")])).collect()
    two = next(r for r in one if r["doc_id"] == 11)
    assert two["text"] == "new line" and two["n_chars"] == 8
    assert linededup.removed_lines(none).count() == linededup.deduplicate(none).count() == 0


def brute_windows(rows):
    first = {}
    for number, text, _ in rows:
        words = words_of(text)
        for a in range(len(words) - 12):
            if number is not None:
                key = tuple(words[a:a + 13])
                first[key] = min(first.get(key, number), number)
    out = []
    for number, text, _ in rows:
        words = words_of(text)
        gone = np.zeros(len(words), bool)
        for a in range(len(words) - 12):
            if number is not None and first[tuple(words[a:a + 13])] < number:
                gone[a:a + 13] = True
        out.append((number, len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return sorted(out, key=str)


def got_windows(frame):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in substrings.remove_repeats(frame).collect()), key=str)


@pytest.mark.parametrize("hot", [2000, 3])
def test_substrings_agree_with_brute_force(make, monkeypatch, hot):
    monkeypatch.setattr(substrings, "_HOT_ROWS", hot)
    r = random.Random(4)
    vocabulary = [f"v{i}" for i in range(25)]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(10, 40))] for _ in range(6)]
    rows = []
    for number in range(50):
        words = []
        for _ in range(r.randint(0, 4)):
            words += r.choice(passages)[r.randint(0, 4):] if r.random() < 0.6 else [r.choice(vocabulary) for _ in range(r.randint(1, 30))]
        rows.append((number, " ".join(words), "en"))
    rows += [(60, "spam " * 200, "en"), (61, "spam " * 50, "en"), (62, "spam " * 200, "en")]
    assert got_windows(make(rows)) == brute_windows(rows)
    assert sum(x[2] for x in brute_windows(rows)) > 500


def test_chunks_have_the_words_of_their_texts(monkeypatch):
    r = random.Random(3)
    blanks = [" ", "  ", "\t", "\n", "\r\n", "\x0b\x0c "]
    texts = [None, "", " ", "\n\n", "one", " lead", "trail ", "\u00a0kept \u2003 whole\x00", "é" * 300]
    for _ in range(60):
        texts.append("".join(r.choice(["a", "bb", "ä漢", "\U0001F600x"]) + r.choice(blanks) for _ in range(r.randint(0, 60))))
    hashes, column = {}, substrings.pa.array(texts)
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(substrings, "_CHUNK", size)
        rows = 0
        for begin, chunk in substrings.chunks(column):
            assert begin == rows
            for i, (a, b) in enumerate(zip(chunk.first[:-1], chunk.first[1:])):
                words = substrings.split_words(texts[rows])
                assert [chunk.words(w, w + 1) for w in range(a, b)] == words
                assert all(hashes.setdefault(w, h) == h for w, h in zip(words, chunk.hashes[a:b].tolist()))
                rows += 1
            for text, first, last, _ in zip(*chunk.passages()):
                assert chunk.first[text] <= first <= last <= chunk.first[text + 1] - substrings.WINDOW
        assert rows == len(texts)
    assert len(set(hashes.values())) == len(hashes)


def test_a_line_repeated_in_and_across_documents(make, monkeypatch):
    monkeypatch.setattr(substrings, "_HOT_ROWS", 3)
    line = " ".join(f"term{i}" for i in range(15))
    rows = [(i, "\n".join([f"head{i} of text {i}"] + [line] * (1 + i % 7)), "en") for i in range(40)]
    found = got_windows(make(rows))
    expected = sorted(brute_windows(rows), key=str)
    assert found == expected


def test_substrings_of_odd_rows(odd, none):
    assert got_windows(odd) == brute_windows(ODD)
    assert substrings.remove_repeats(none).count() == 0
    assert (8, 60_000, 60_000, "") in got_windows(odd) and len(words_of(LONG)) == 60_000
