"""Periodic runs against a search of all lags."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from civiq.llm import periodic, queries


def brute_runs(words):
    """Stretches of matches for every lag, kept where no smaller period fits."""
    n, found = len(words), []
    for lag in range(1, n // 4 + 1):
        i = 0
        while i < n - lag:
            j = i
            while j < n - lag and words[j] == words[j + lag]:
                j += 1
            length = j + lag - i
            stretch = words[i:i + length]
            if j > i and length >= max(6, 4 * lag) and not any(stretch[p:] == stretch[:-p] for p in range(1, lag)):
                found.append((i, length, lag))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, edit):
    words = (text or "").encode().split()
    order = edit(doc_id, len(words)) if edit and words else None
    words = words if order is None else [words[i] for i in order]
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256(listed.encode()).hexdigest(), kept.decode(), [tuple(r) for r in runs])


def plain(row):
    return (*row[:-1], [tuple(r) for r in row[-1]])


def made_up(seed):
    """Words from a small alphabet, with repeated phrases of all lengths."""
    pick, words = random.Random(seed), []
    letters, size = pick.choice([1, 2, 2, 3, 5]), pick.randint(0, 150)
    while len(words) < size:
        kind = pick.random()
        if kind < 0.4:
            words += [pick.randrange(letters) for _ in range(pick.randint(1, 14))] * pick.randint(1, 6)
        elif words and kind < 0.8:
            words += words[-pick.randint(1, len(words)):] * pick.randint(1, 4)
        else:
            words.append(pick.randrange(letters + 2))
    return words[:200]


@pytest.mark.parametrize("block", range(8))
def test_runs_are_those_of_all_lags(block):
    for seed in range(block * 150, block * 150 + 150):
        words = made_up(seed)
        assert periodic.periodic_runs(np.array(words, np.int64)) == brute_runs(words), words


def test_a_period_whose_short_grams_all_recur_inside_it():
    a, b = list(range(8)), list(range(10, 18))
    unit = [w for bit in (0, 0, 0, 1, 0, 1, 1, 1) for w in (b if bit else a)]
    words = [99] + unit * 4 + unit[:5] + [98]
    assert periodic.periodic_runs(np.array(words, np.int64)) == brute_runs(words) == [(1, 4 * len(unit) + 5, len(unit))]


def test_classes_cover_every_lag_once():
    lags = [lag for low, high, _ in periodic.lag_classes(4000) for lag in range(low, high + 1)]
    assert lags[:1000] == list(range(1, 1001))
    assert all(high <= k for _, high, k in periodic.lag_classes(4000))


def test_long_texts_take_one_extension_for_each_lag(monkeypatch):
    calls = []
    reach = periodic._reach
    monkeypatch.setattr(periodic, "_reach", lambda *a: calls.append(a[2]) or reach(*a))
    assert periodic.periodic_runs(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    assert len(calls) <= 2
    assert periodic.periodic_runs(np.arange(60_000) % 9000) == [(0, 60_000, 9000)]


TEXTS = [
    (1, "a a a a a a b", "en"), (2, "x y x y x y x y", None), (3, "x y x y x y x", "en"), (3, "x y x y x y x", "en"), (4, None, None), (5, "", "en"),
    (6, " \t\n ", "en"), (None, "q q q q q q q", "en"), (7, "Ünï Ünï\x0bÜnï Ünï Ünï Ünï Ünï Ünï Ünï Ünï Ünï", "fr"),
    (8, "one two three " * 9 + "end end end end end end end", "en"), (9, "a b " * 30 + "c " + "a b " * 30, "en"),
]


def test_odd_rows(make, none):
    got = periodic.find_runs(make(TEXTS)).collect()
    assert sorted(map(plain, got), key=repr) == sorted((expected(i, t, None) for i, t, _ in TEXTS), key=repr)
    assert periodic.find_runs(none).collect() == []


def test_odd_fixture_keeps_its_rows(odd):
    assert periodic.find_runs(odd).count() == odd.count()


def test_edited_texts_as_the_query_makes_them(make):
    pick = random.Random(4)
    rows = [(i, " ".join(f"w{pick.randrange(400)}" for _ in range(pick.randint(0, 160))), "en") for i in range(150)]
    changed = [i for i, t, _ in rows if zlib.crc32(str(i).encode()) % 10 == 0 and t]
    assert len(changed) > 5
    wanted = sorted((expected(i, t, queries.made_periodic) for i, t, _ in rows), key=repr)
    got = sorted(map(plain, periodic.find_runs(make(rows), rearranged=queries.made_periodic).collect()), key=repr)
    assert got == wanted and sum(r[1] for r in got) > 3


def test_registered_query_on_given_documents(llm):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in llm.read.parquet(f"{folder}/documents.parquet").collect()}
    short = {i: t for i, t in docs.items() if len((t or "").split()) < 700}
    found = {r["doc_id"]: r for r in queries.QUERIES["op12_periodic"](llm, folder).collect()}
    assert found.keys() == docs.keys() and len(short) > 100
    for i, t in short.items():
        want = expected(i, t, queries.made_periodic)
        assert tuple(found[i]) == (*want[:-2], hashlib.sha256(want[-2].encode()).hexdigest())
