"""Binary records, packing and fingerprints."""

import hashlib
import io
import random
import struct
import zlib

import numpy as np
import pytest

from civiq.llm import fingerprints, packing, records, tokens
from civiq.session import scratch_dir
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def state():
    return tokens.load(tokens.default_vocabulary())


def plain(text, state):
    return state["tokenizer"].encode(text or "", add_special_tokens=False).ids


def test_words_encode_as_whole_texts_do(state):
    r = random.Random(3)
    parts = ["a", "Bc", "é", "É", "é", "ß", "İ", "Σ", "'s", "'T", "'", ".", " ", "\n", " ", " ", "\x1c", "\x85",
             "1", "½", "漢", "ᄒ", "\U0001F600", "_", "%%%", "ſ", "ﬁ", "<|endoftext|>", "<|ENDoftext|>", "don't"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert np.frombuffer(tokens.encode(text, state), state["width"]).tolist() == plain(text, state), repr(text)


def test_frames_round_trip_and_tell_damage():
    payload = records.to_payload(-5, np.array([1, 70_000], "<u4"))
    data = records.frame(payload)
    assert records.read_frame(io.BytesIO(data)) == payload
    key, ids = records.from_payload(payload)
    assert key == -5 and ids.tolist() == [1, 70_000]
    assert records.from_payload(records.to_payload(None, np.array([7], "<u4")))[0] is None
    assert records.read_frame(io.BytesIO(b"")) is None
    for at in range(len(data)):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(bytes(broken)))
    with pytest.raises(ValueError):
        records.read_frame(io.BytesIO(data[:-1]))
    assert struct.unpack("<Q", data[:8])[0] == len(payload)


def test_records_round_trip(llm, odd, none, state):
    manifest = records.write_records(odd, scratch_dir(llm, "records"), parts=3)
    rows = sorted(records.read_records(llm, manifest).collect(), key=lambda r: r["start"])
    order = sorted(ODD, key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r["doc_id"] for r in rows] == [x[0] for x in order]
    want = sorted((x[0] if x[0] is not None else -1, np.array(plain(x[1], state) + [1], "<u4").tobytes()) for x in ODD)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted(
        (i, len(b) // 4, zlib.crc32(b)) for i, b in want)
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1].tolist()]
    path, count = next((r["path"], r["records"]) for r in manifest.collect() if r["records"] > 2)
    forward = list(records.read_at(path, list(range(count))))
    backward = list(records.read_at(path, list(range(count))[::-1]))
    assert [k for k, _ in forward] == [k for k, _ in backward][::-1]
    assert records.round_trip(none).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_and_no_bin_overflows(seed):
    r = random.Random(seed)
    counts = {r.randint(1, 100): r.randint(1, 400) for _ in range(r.randint(1, 60))}
    plan = packing.best_two_fit(counts, 100)
    used = {}
    for times, lengths in plan:
        assert sum(lengths) <= 100 and times > 0
        for length in lengths:
            used[length] = used.get(length, 0) + times
    assert used == counts
    bins, least = sum(t for t, _ in plan), -(-sum(k * v for k, v in counts.items()) // 100)
    halves = sum(v for k, v in counts.items() if k > 50)
    assert bins <= 1.12 * max(least, halves) + 2


def test_two_replace_the_shortest():
    # Greedy takes 60 and 30; 20 + 20 fill the gap of 40 that 30 leaves exactly.
    assert packing.best_two_fit({60: 1, 30: 1, 20: 2}, 100)[0] == (1, [60, 20, 20])


def test_packing_of_odd_rows(odd, none, state):
    rows = packing.pack_documents(odd, capacity=512).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    want = []
    for number, text, _ in ODD:
        ids = np.array(plain(text, state) + [0], "<u4")
        want += [(str(number), a // 512, a, len(ids[a:a + 512]), zlib.crc32(ids[a:a + 512].tobytes())) for a in range(0, len(ids), 512)]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    assert packing.pack_documents(none).count() == 0


def test_shares_of_ranks_agree(odd, monkeypatch):
    monkeypatch.setattr(packing, "_SHARE", 3)
    rows = packing.pack_documents(odd, capacity=512).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)


def test_fingerprints_follow_edits():
    r = random.Random(1)
    text = "".join(r.choice("abcdefghij ") for _ in range(6000))
    near = text[:3000] + "x" + text[3000:]
    moved = text[3000:] + text[:3000]
    other = "".join(r.choice("abcdefghij ") for _ in range(6000))
    mark = fingerprints.fingerprint
    assert fingerprints.likeness(mark(text), mark(text)) == 1.0 == fingerprints.likeness(mark(None), mark(""))
    assert fingerprints.likeness(mark(text), mark(near)) > 0.9
    assert fingerprints.likeness(mark(text), mark(other)) < 0.1
    # The same k-mers in another order: a set's signature would hardly change.
    assert fingerprints.likeness(mark(text), mark(moved)) < 0.8


def test_long_texts_have_the_same_entries_by_either_way():
    text = "".join(random.Random(2).choice("abcd") for _ in range(9000))
    h = fingerprints.kmer_hashes(text)
    shift = np.uint64(64 - fingerprints.BINS.bit_length() + 1)
    fast, slow = fingerprints._least(h, shift), np.argsort(h, kind="stable")
    for bin_ in range(fingerprints.BINS):
        a, b = ([i for i in order if int(h[i] >> shift) == bin_][:fingerprints.CHOSEN] for order in (fast, slow))
        assert a == b


def test_occurrences_are_numbered():
    h = fingerprints.kmer_hashes("ab" * 50)
    assert len(h) == 85 and len(np.unique(h)) == 85


def test_neighbours_of_odd_rows(odd, none):
    rows = fingerprints.compare_neighbours(odd).collect()
    assert len(rows) == len(ODD)
    single = {i: t or "" for i, t, _ in ODD if i not in (2, None)}
    nexts = {11: 10, 10: 9, 9: 8, 8: 7, 7: 6, 6: 5, 5: 4, 4: 3}
    for r in rows:
        if r["doc_id"] in nexts:
            text, other = single[r["doc_id"]], single[nexts[r["doc_id"]]]
            n = len(text)
            assert r["n_chars"] == n
            assert r["edited_sha256"] == hashlib.sha256((text[:n - n // 3] + other[:n // 3]).encode()).hexdigest()
    assert fingerprints.compare_neighbours(none).count() == 0
    assert next(r for r in rows if r["doc_id"] == 8)["near_next"] == 1.0


def test_a_single_document_follows_itself(make):
    row = fingerprints.compare_neighbours(make([(5, "abcdef", "en")])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0
