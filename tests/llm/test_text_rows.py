"""Operators that judge each document by itself or count it, against plain versions."""

import bisect
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tests.llm.rows import BENCHMARK, documents, frame
from txn_risk.llm import decontamination, licenses, packing, quality, repeats, sharding, toxicity
from txn_risk.llm.queries import vocabulary


def as_multiset(rows):
    return sorted(map(repr, rows))


def test_license_places_match_plain_search(spark):
    docs = documents()
    got = licenses.scan(frame(spark, docs)).collect()
    want = [(i, *brute.license_places(t)) for i, t in docs]
    assert as_multiset((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == \
        as_multiset(want)
    labels = {r.doc_id: r.labels for r in got}
    by_text = {t: labels[i] for i, t in docs if t and i}
    assert by_text["Released under the MIT License."] == "mit"
    assert by_text["Licensed under the Apache License, Version 2.0."] == "apache-2.0"
    assert labels[16] == labels[17] == ""
    assert all(0 <= r.score <= 1 and (r.score == 1 or not r.base_labels) for r in got)


def test_license_scan_of_nothing(spark):
    assert licenses.scan(frame(spark, [])).count() == 0


def test_contamination_matches_plain_search(spark):
    docs = documents()
    benchmark = frame(spark, BENCHMARK, "item_id long, text string")
    got = decontamination.scan(frame(spark, docs), benchmark).collect()
    assert as_multiset(tuple(r) for r in got) == as_multiset((i, *brute.contamination(t, BENCHMARK)) for i, t in docs)
    assert decontamination.scan(frame(spark, []), benchmark).count() == 0
    nothing = decontamination.scan(frame(spark, docs), frame(spark, [], "item_id long, text string"))
    assert not any(r.contaminated for r in nothing.collect())


def test_contamination_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 8)
    docs = documents()
    benchmark = frame(spark, BENCHMARK, "item_id long, text string")
    got = decontamination.scan(frame(spark, docs), benchmark).collect()
    assert as_multiset(tuple(r) for r in got) == as_multiset((i, *brute.contamination(t, BENCHMARK)) for i, t in docs)


@pytest.mark.parametrize("kept,compiled", [(3, 3), (2, 12)])
def test_blocks_are_compiled_once_while_they_are_kept(monkeypatch, kept, compiled):
    monkeypatch.setattr(decontamination, "KEPT_BLOCKS", kept)
    monkeypatch.setattr(decontamination, "HELD_BYTES", 1)
    monkeypatch.setattr(decontamination, "_COMPILED", {})
    made, tables = [], decontamination.tables
    monkeypatch.setattr(decontamination, "tables", lambda rows, window: (made.append(rows), tables(rows, window))[1])
    blocks = [SimpleNamespace(value=BENCHMARK[i::3]) for i in range(3)]
    docs = documents()
    batches = [pa.RecordBatch.from_pydict({"text": [t for _, t in docs[i::4]]}) for i in range(4)]
    got = [x for part in decontamination._held(iter(batches))
           for x in decontamination._search_each(blocks, 10, part.column(0).to_pylist())]
    want = [brute.contamination(t, BENCHMARK) for i in range(4) for _, t in docs[i::4]]
    assert [(n, h, len({i for i in f if i is not None})) for n, h, f in got] == [x[:3] for x in want]
    assert len(made) == compiled
    assert len(decontamination._COMPILED) == kept


def test_clean_documents_stay(spark):
    docs = documents()
    kept = decontamination.without_contaminated(
        frame(spark, docs), frame(spark, BENCHMARK, "item_id long, text string"), least_words=1
    )
    assert as_multiset((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()) == as_multiset(
        (i, t) for i, t in docs if not brute.contamination(t, BENCHMARK)[-1]
    )


@pytest.mark.parametrize("length,anchor,together", [(40, 12, 1000), (40, 12, 1), (100, 30, 2)])
def test_repeats_match_plain_search(spark, monkeypatch, length, anchor, together):
    monkeypatch.setattr(repeats, "RUNS_TOGETHER", together)
    docs = documents()
    got = repeats.removed(frame(spark, docs), length, anchor).collect()
    want = [(i, *x) for (i, _), x in zip(docs, brute.repeats([t for _, t in docs], length), strict=True)]
    assert as_multiset(tuple(r) for r in got) == as_multiset(want)


def test_a_line_over_and_over_is_a_few_rows(spark, monkeypatch):
    rng = random.Random(8)
    line = "".join(rng.choices("abcdefgh", k=50)) + "\n"
    noise = lambda: "".join(rng.choices("ijklmnop", k=90))
    docs = [(i, noise() + line * 200 + noise()) for i in range(4)] + [(4, noise()), (5, line * 200)]
    sizes, settled = {}, repeats.settle

    def counted(df, name):
        out = settled(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(repeats, "settle", counted)
    got = repeats.removed(frame(spark, docs), 40, 12).collect()
    want = [(i, *x) for (i, _), x in zip(docs, brute.repeats([t for _, t in docs], 40), strict=True)]
    assert as_multiset(tuple(r) for r in got) == as_multiset(want)
    assert len(docs) < sizes["shared-runs"] < 20 * len(docs)


@pytest.mark.parametrize("shared", [399, 401])
def test_transforms_stay_small_where_many_runs_share_an_anchor(monkeypatch, shared):
    rng = np.random.default_rng(5)
    noise = lambda n: bytes(rng.integers(97, 123, n, np.uint8)).decode()
    passage = noise(shared)
    texts = [noise(500) + passage + noise(500) for _ in range(300)]
    found = [repeats.runs(t.encode(), 400, 64) for t in texts]
    often = [a for a, n in Counter(a for f in found for a in f["anchor"].tolist()).items() if n == 300]
    own = [
        [{"anchor": a, "start": s, "size": z, "at": at, "content": c, "kinds": 2000}
         for a, s, z, at, c in zip(*(f[k].tolist() for k in ("anchor", "start", "size", "at", "content"))) if a in often]
        for f in found
    ]
    assert often and all(own)
    sizes, judge = [], repeats.repeated_windows
    monkeypatch.setattr(repeats, "TRANSFORM_BYTES", 20_000)
    monkeypatch.setattr(
        repeats, "repeated_windows", lambda pieces, n: (sizes.append(sum(map(len, pieces))), judge(pieces, n))[1]
    )
    rows = [r for b in repeats._cut_runs(400, 64)(iter([pa.RecordBatch.from_pydict({"text": texts, "open": own})]))
            for r in b.to_pylist()]
    weight = Counter()
    for r in rows:
        weight[r["anchor"], r["block"]] += len(r["bytes"])
    small = [r for r in rows if weight[r["anchor"], r["block"]] <= 20_000]
    large = [r for r in rows if weight[r["anchor"], r["block"]] > 20_000]
    if large:
        batch = repeats._batch({k: [r[k] for r in large] for k in large[0]})
        small += [r for b in repeats._single_windows(400)(iter([batch])) for r in b.to_pylist()]
    small.sort(key=lambda r: (r["anchor"], r["block"]))
    batch = repeats._batch({k: [r[k] for r in small] for k in small[0]})
    got = [r for b in repeats._judge(400)(iter([batch])) for r in b.to_pylist()]
    assert max(sizes) <= 2 * 20_000
    windows = sum(b - a for r in got for a, b in zip(r["windows"][::2], r["windows"][1::2], strict=True))
    every = Counter(
        t[s:s + 400] for t, f in zip(texts, own, strict=True) for r in f for s in range(r["start"], r["start"] + r["size"])
    )
    assert windows == sum(n for n in every.values() if n > 1) > 0


def passage_rows():
    """Shared passages with fewer, just as many and more bytes than the longer length; at edges, cut short, copied."""
    rng = np.random.default_rng(8)
    noise = lambda n: " ".join(f"w{x}" for x in rng.integers(10 ** 6, 10 ** 7, n))
    short, long_ = " ".join(f"a{i}" for i in range(9)), " ".join(f"bcde{i}" for i in range(12))
    rows = [noise(6) + " " + p + " " + noise(k) for p in (short, long_, "x" * 60, "ä" * 30) for k in (0, 1, 9)]
    rows += [short, short + " " + noise(5), short + "q " + noise(3), long_[:50], long_[20:], None, "", long_, long_]
    rows += [noise(9) + " " + short + " " + noise(2) + " " + short] * 3 + [rows[0][:-2] + noise(1), "k" * 35, "k" * 35]
    return list(enumerate(rows))


@pytest.mark.parametrize("passage,length,together", [(24, 40, 1000), (24, 64, 1), (30, 31, 1000), (40, 40, 1)])
def test_two_lengths_from_one_expansion(spark, monkeypatch, passage, length, together):
    monkeypatch.setattr(repeats, "RUNS_TOGETHER", together)
    monkeypatch.setattr(repeats, "PASSAGE_WORDS", 5)
    read_over = repeats.passages
    monkeypatch.setattr(repeats, "passages", lambda raw, stretches: read_over(raw, stretches, 5))
    docs = documents() + [(5000 + i, t) for i, t in passage_rows()]
    texts = [t for _, t in docs]
    got = repeats.removed(frame(spark, docs), length, 10, passage=passage).collect()
    near = brute.passages(texts, passage, 5)
    want = [
        (i, *x, len(p), sum(b - a for a, b in p))
        for (i, _), x, p in zip(docs, brute.repeats(texts, length), near, strict=True)
    ]
    assert any(n and not gone for _, _, gone, _, _, n, _ in want) or length - passage < 2
    assert as_multiset(tuple(r) for r in got) == as_multiset(want)


def test_runs_grow_to_the_longer_length(monkeypatch):
    rng = np.random.default_rng(1)
    raw = bytes(rng.integers(97, 100, 900, dtype=np.uint8))
    whole = repeats.runs(raw, 40, 8, 70)
    assert whole["size"].sum() == len(raw) - 39 and whole["fit"].sum() == len(raw) - 69
    monkeypatch.setattr(repeats, "CHUNK", 64)
    cut = repeats.runs(raw, 40, 8, 70)
    assert cut["size"].sum() == len(raw) - 39 and cut["fit"].sum() == len(raw) - 69
    # A run that the text's end cuts short is not the same kind as one that goes on.
    assert repeats.runs(raw[:-20], 40, 8, 70)["content"][-1] not in whole["content"]


def test_passages_hold_whole_words():
    raw = b"one two three four"
    assert repeats.passages(raw, [(0, 18)], 4) == [(0, 18)]
    assert repeats.passages(raw, [(1, 18)], 4) == [] and repeats.passages(raw, [(1, 18)], 3) == [(1, 18)]
    assert repeats.passages(raw, [(3, 14)], 2) == [(3, 14)] and repeats.passages(raw, [(3, 13)], 2) == [(3, 13)]
    assert repeats.passages(raw, [(4, 6)], 1) == []


def test_repeats_of_nothing_and_in_one_text(spark):
    assert repeats.removed(frame(spark, [])).count() == 0
    text = "q" * 30 + "0123456789" * 5 + "w" * 7 + "0123456789" * 5
    got = repeats.removed(frame(spark, [(1, text)]), 20, 6).first()
    assert tuple(got) == (1, *brute.repeats([text], 20)[0])


def test_long_texts_are_cut_into_chunks(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 64)
    rng = np.random.default_rng(1)
    raw = bytes(rng.integers(97, 100, 900, dtype=np.uint8))
    found = repeats.runs(raw, 40, 8)
    assert found["size"].sum() == len(raw) - 39
    assert (found["at"] >= found["size"] - 1).all()


def test_shortened_texts(spark):
    lead = "".join(chr(0xE0 + i) for i in range(30))
    docs = [(1, lead + "0123456789" * 5), (2, "x" + "0123456789" * 5), (3, None)]
    got = {r.doc_id: r.text for r in repeats.without_repeats(frame(spark, docs), 50, 10).collect()}
    assert got == {1: lead, 2: "x", 3: None}


def test_passages_are_cut_from_texts(spark):
    passage = " ".join(f"word{i}" for i in range(60))[:380]
    docs = [(1, "first " + passage + " end"), (2, "other " + passage + " stop"), (3, "alone"), (4, None)]
    got = {r.doc_id: r.text for r in repeats.without_repeats(frame(spark, docs), passage=255).collect()}
    assert got == {1: "firstend", 2: "otherstop", 3: "alone", 4: None}
    got = {r.doc_id: r.text for r in repeats.without_repeats(frame(spark, docs)).collect()}
    assert got == dict(docs)


def test_pieces_are_the_tokenizer_s_ids(spark):
    from tokenizers import Tokenizer

    docs = documents()
    encoder = Tokenizer.from_file(vocabulary())
    got = packing.pack_documents(frame(spark, docs), vocabulary(), 64, keep_ids=True).collect()
    want = []
    for i, text in docs:
        ids = np.asarray([*encoder.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(ids) - 1) % 64 + 1
        cuts = [0, *range(first, len(ids) + 1, 64)]
        want += [
            (i, n, a, b - a, brute.crc(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))
        ]
    assert as_multiset((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == as_multiset(want)
    assert all(brute.crc(r.ids) == r.ids_crc32 for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= 1.02 * sum(r.length for r in got) / 64 + 1


def test_cut_texts_keep_the_library_s_ids(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "LAID", 7)
    monkeypatch.setattr(packing, "REMEMBERED", 300)
    library, encoder = Tokenizer.from_file(vocabulary()), packing.Encoder(vocabulary())
    rng = random.Random(3)
    atoms = [*"aZé×ʯ0.,!<|>'\n\t\r\x1c\x85\xa0\u2003\u3000中\U0001f600\xff\x00", *" " * 9, "'ll", " the", "<|endoftext|>"]
    for n in range(0, 400, 20):
        drawn = ["".join(rng.choices(atoms, k=rng.choice((0, 1, 3, 20)))) for _ in range(n)]
        want = [np.asarray(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in drawn]
        assert encoder.encode(pa.array(["x", *drawn, "y"]).slice(1, n)) == want


def test_a_word_is_learned_once_whatever_follows_it(monkeypatch):
    encoder = packing.Encoder(vocabulary())
    merged, merge = [], encoder._merge
    monkeypatch.setattr(encoder, "_merge", lambda pieces: merge(merged.extend(pieces) or pieces))
    words = [f"wo{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    text = " " + " ".join(w + after for w in words for after in ("", ",", ".", "!!", ".\nthe"))
    encoder.encode(pa.array([text]))
    assert sorted(merged) == sorted([*(" " + w for w in words), ",", ".", "!!", "\n", "the"])
    assert len(encoder.known) == len(merged)


def test_ranking_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 3)
    docs = [(i, "same words here") for i in range(50)] + [(i, "x " * i) for i in range(40)]
    got = packing.pack_documents(frame(spark, docs), vocabulary(), 16).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert packing.pack_documents(frame(spark, []), vocabulary()).count() == 0


def test_best_fit_uses_every_item_once():
    rng = np.random.default_rng(5)
    histogram = {int(k): int(v) for k, v in zip(range(1, 101), rng.integers(0, 300, 100)) if v}
    plan = packing.best_fit(histogram, 100)
    for length, count in histogram.items():
        starts = plan.ranks[length]
        assert starts[0] == 0 and starts == sorted(starts) and starts[-1] < count
    # Plain best fit decreasing, item by item: the fullest sequence that still has room.
    rooms: list[int] = []
    for length in sorted((k for k, n in histogram.items() for _ in range(n)), reverse=True):
        at = bisect.bisect_left(rooms, length)
        left = rooms.pop(at) - length if at < len(rooms) else 100 - length
        bisect.insort(rooms, left)
    assert plan.n_sequences == len(rooms)


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shards_are_even_and_slots_gapless(spark, law):
    docs = documents() + [(1000 + i, "hot text") for i in range(400)]
    got = sharding.shard(frame(spark, docs), 4, law, ranges_per_shard=8).collect()
    want = [(i, len((t or "").encode()) + 1, brute.crc((t or "").encode())) for i, t in docs]
    assert as_multiset((r.doc_id, r.size, r.text_crc32) for r in got) == as_multiset(want)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    assert set(shards) <= set(range(4))
    for rows in shards.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    weigh = (lambda r: r.size) if law == "bytes" else (lambda r: 1)
    weights = [sum(map(weigh, rows)) for rows in shards.values()]
    assert max(weights) - min(weights) <= 2 * max(map(weigh, got)) - (law == "rows")
    assert {r.grown_shard for r in got} == {None}
    assert sharding.shard(frame(spark, []), 4, law).count() == 0


def labelled(n=240):
    rng = np.random.default_rng(0)
    vocabulary_ = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    docs, marks = [], []
    for i in range(n):
        own = list(rng.choice(vocabulary_, 40))
        toxic, good = int(i % 4 == 0), int(i % 3 != 0)
        if toxic:
            own.insert(int(rng.integers(40)), "vileword" + str(rng.choice(["s", "en", "ung"])))
        if not good:
            own = [w + "%%%" for w in own]
        docs.append((i, " ".join(own)))
        marks.append((i, good, toxic))
    return docs, marks


def accuracy(rows, marks, at):
    held = [(r.predicted, marks[r.doc_id][at]) for r in rows if r.doc_id is not None and r.doc_id in marks and r.held_out]
    return sum(a == b for a, b in held) / len(held)


def test_classifiers_learn_and_take_any_text(spark):
    docs, marks = labelled()
    labels = frame(spark, marks + [(None, 1, 1), (9999, None, None)], "doc_id long, quality int, toxic int", False)
    known = {m[0]: m for m in marks}
    awkward = [(i + 5000 if i else i, t) for i, t in documents()]
    table = frame(spark, docs + awkward)
    for module, at, least in ((quality, 1, 0.95), (toxicity, 2, 0.95)):
        model = module.fit(table, labels)
        got = module.classify(table, model, 0.5).collect()
        assert len(got) == len(docs) + len(awkward)
        assert accuracy(got, known, at) >= least
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
        assert {r.held_out for r in got if r.doc_id == 5} == {brute.crc(b"5") % 5 == 0}
        assert module.classify(frame(spark, []), model, 0.5).count() == 0
    kept = quality.without_rejected(table, quality.fit(table, labels), 0.5)
    assert set(kept.columns) == set(table.columns)


def test_classifiers_without_labels(spark):
    empty = frame(spark, [], "doc_id long, quality int, toxic int", False)
    docs = frame(spark, documents())
    for module in (quality, toxicity):
        scores = [r.score for r in module.classify(docs, module.fit(docs, empty), 0.5).collect()]
        assert all(0 <= s <= 1 for s in scores)
