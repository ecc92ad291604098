"""Operators 1, 7, 8 against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from util import ODD, documents, prose

from folioscan.llm import op1_spans, op7_suffix, op8_simhash
from folioscan.llm._graph import components


def _corpus():
    shared, long = prose(1, 60), prose(2, 40)
    texts = [prose(10 + k, 80) for k in range(6)]
    texts += [texts[0], texts[0], texts[1].replace(" ", "  ", 1), shared + " " + prose(31, 50), prose(32, 50) + " " + shared, prose(33, 30) + "\n" + shared + "\n" + prose(34, 30)]
    texts += [long + " " + long + " " + prose(35, 20), prose(36, 10) + long[5:], "é" * 400, "x" + "é" * 150]
    return texts + ODD


def brute7(rows, length):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        cover = bytearray(len(data))
        for a in range(len(data) - length + 1):
            w = data[a : a + length]
            if w in seen:
                cover[a : a + length] = b"\1" * length
            else:
                seen.add(w)
        kept = bytes(b for b, c in zip(data, cover, strict=True) if not c)
        spans = len(re.findall(rb"\x01+", bytes(cover)))
        out.append((i, len(data), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("order", [1, -1])
def test_suffix_dedup_is_brute_force(spark, order):
    texts = _corpus()
    ids = [100 + order * k for k in range(len(texts))]
    docs = documents(spark, texts, extra=True, ids=ids).repartition(3)
    got = sorted(tuple(r) for r in op7_suffix.digest(spark, docs).collect())
    assert got == sorted(brute7(list(zip(ids, texts, strict=True)), 100))


def test_suffix_dedup_short_windows(spark):
    texts = ["abcabcabcabcabcabcabcabcabcabcabcabc" * 3, "xyz" + "abc" * 30, "q" * 90, "q" * 45 + "r" + "q" * 50]
    got = sorted(tuple(r) for r in op7_suffix.digest(spark, documents(spark, texts), 40).collect())
    assert got == brute7(list(enumerate(texts)), 40)


def test_suffix_dedup_repeated_ids_and_nulls(spark):
    t = prose(3, 60)
    size = len(t.encode())
    got = {(r.doc_id, r.n_removed) for r in op7_suffix.digest(spark, documents(spark, [t, t, t], ids=[5, 5, 7])).collect()}
    assert got == {(5, 0), (7, size)}
    # Rows without an id come before all others.
    got = {(r.doc_id, r.n_removed) for r in op7_suffix.digest(spark, documents(spark, [t, t, t], ids=[-9, 7, None])).collect()}
    assert got == {(None, 0), (-9, size), (7, size)}
    assert op7_suffix.digest(spark, documents(spark, [])).count() == 0


def test_suffix_removal_keeps_columns(spark):
    t = prose(3, 60)
    docs = documents(spark, [t, "ab " + t, None], extra=True)
    out = op7_suffix.remove_repeats(spark, docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].text == t and rows[2].text is None
    assert len(rows[1].text) < len(t) / 2 and rows[1].n_chars == len(rows[1].text) and rows[1].kept == "yes"


def test_payloads_do_not_grow_with_batches(spark, monkeypatch):
    """Twenty Arrow batches of one task send a bucket one payload a table of rows, and levels get many payloads at once."""
    from folioscan.llm._levels import Levels

    sent, deal = [], op7_suffix.by_bucket
    monkeypatch.setattr(op7_suffix, "by_bucket", lambda rows, *more: (sent.append(rows), deal(rows, *more))[1])
    texts = [prose(200 + k % 50, 300) for k in range(60)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        docs = documents(spark, texts).coalesce(1)
        got = sorted(tuple(r) for r in op7_suffix.digest(spark, docs).collect())
        most = max(r["count"] for r in sent[0].filter(f"kind = {op7_suffix.STRETCH}").groupBy("key").count().collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == brute7(list(enumerate(texts)), 100)
    assert most == 1

    class Counted(Levels):
        calls = 0

        def add(self, batch):
            self.calls += 1
            return super().add(batch)

    from folioscan.llm._common import pack

    levels, lost, dtypes = Counted(op7_suffix.WINDOWS), 0, op7_suffix.WINDOWS
    for rows in levels.take(pack(*(np.array([x], d) for x, d in zip((k % 700, k, 0, 0), dtypes, strict=True))) for k in range(1000)):
        lost += len(rows[0])
    assert levels.calls == 1 and lost == 300 and sorted(levels.all()[1].tolist()) == list(range(700))


def test_pipeline_stage_deals_out_once_a_task(spark, monkeypatch):
    """The pipeline's third stage too: ten Arrow batches of one task, one payload a bucket."""
    import corpus_pipeline

    sent, deal = [], op7_suffix.by_bucket
    monkeypatch.setattr(op7_suffix, "by_bucket", lambda rows, *more: (sent.append(rows), deal(rows, *more))[1])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        texts = [prose(300 + k % 25, 200) for k in range(30)]
        out = {r.doc_id: r.text for r in corpus_pipeline.suffix_array_dedup(spark, documents(spark, texts).coalesce(1), "").collect()}
        most = max(r["count"] for r in sent[0].filter(f"kind = {op7_suffix.STRETCH}").groupBy("key").count().collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert out == {k: t if k < 25 else "" for k, t in enumerate(texts)}
    assert most == 1


def test_buckets_make_no_row_for_each_document(spark, monkeypatch):
    """Copies of 150 texts in other tasks, and 150 texts with another beginning and end: 24 buckets and 4 map tasks send rows to blocks of documents, not to each."""
    made, stage = {}, op7_suffix.stage

    def staged(spark, df, name):
        out = stage(spark, df, name)
        made[name] = {r.kind: r["count"] for r in out.groupBy("kind").count().collect()}
        return out

    monkeypatch.setattr(op7_suffix, "stage", staged)
    first = [prose(500 + k, 80) for k in range(300)]
    later = [t if k % 2 else prose(900 + k, 10) + t[9:-9] + prose(1300 + k, 10) for k, t in enumerate(first)]
    got = sorted(tuple(r) for r in op7_suffix.digest(spark, documents(spark, first + later)).collect())
    assert got == brute7(list(enumerate(first + later)), 100) and sum(r[2] > 0 for r in got) == 300
    assert made["earliest"][0] <= (24 + 4) * 24 and made["windows"][0] <= (24 + 4) * 24

    # Small tables dealt widely don't make a row for each pair of buckets; a block takes 16 buckets' worth of covered parts, or 4 of grams, at most.
    from folioscan.llm._levels import blocks

    assert [blocks(n) for n in (24, 64, 422, 6000)] == [24, 64, 64, 375]
    assert [blocks(n, op7_suffix.GRAM_BUCKETS) for n in (24, 64, 422, 6000)] == [24, 64, 105, 1500]


def test_map_tasks_take_and_keep_little_memory(monkeypatch):
    """Twelve million bytes of text: small batches of small payloads, all stretches in them, and nothing of note held at the peak or afterwards."""
    import tracemalloc

    import pyarrow as pa

    from folioscan.llm._common import columns_of

    class Caught(Exception):
        pass

    class Documents:
        def mapInArrow(self, run, schema):
            raise Caught(run)

    for name, value in {"tune": lambda _: None, "buckets": lambda *_: 5, "_docs": lambda docs: docs}.items():
        monkeypatch.setattr(op7_suffix, name, value)
    with pytest.raises(Caught) as caught:
        op7_suffix.repeated_parts(None, Documents())
    cut = caught.value.args[0]
    texts = [bytes(t).decode() for t in np.random.default_rng(3).integers(97, 123, (3000, 4000), np.uint8)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array(range(k, k + 500)), "text": texts[k : k + 500]}) for k in range(0, 3000, 500)]
    data, starts = op7_suffix._joined(batches[0].column(1))
    want = op7_suffix.stretches(data, starts, np.arange(500), 100, 32)[0]
    found, most, largest = [], 0, 0
    op7_suffix._POWERS[:] = [np.ones(1, np.uint64)] * 2
    tracemalloc.start()
    try:
        for b in cut(iter(batches)):
            largest, most = max(largest, b.nbytes), max(most, *(len(p.as_py()) for p in b["payload"]))
            keys = [columns_of(p.as_py(), op7_suffix.STRETCHES) for k, p in zip(b["kind"].to_pylist(), b["payload"], strict=True) if k == op7_suffix.STRETCH]
            found += [key[doc < 500] for key, doc, *_ in keys]
        del b
        kept, peak = (x >> 20 for x in tracemalloc.get_traced_memory())
    finally:
        tracemalloc.stop()
    assert np.array_equal(np.sort(np.concatenate(found)), np.sort(want))
    assert largest < 3 << 20 and most <= 300_000 and peak < 60 and kept < 20


def test_tasks_leave_no_freed_memory_with_their_workers():
    """The pipeline's workers go from stage to stage: what the steps of a task took and freed is the system's again when they end."""
    import ctypes
    from pathlib import Path

    import pyarrow as pa

    from folioscan.llm._common import steps

    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("only glibc")

    def resident():
        return int(Path("/proc/self/statm").read_text().split()[1]) >> 8

    before, held = resident(), []
    for _ in steps(iter([pa.RecordBatch.from_pydict({"text": ["a"]})])):
        taken = [(np.ones(60_000, np.uint8), np.ones(2000, np.uint8)) for _ in range(2500)]
        held += [small for _, small in taken]
        del taken
    assert len(held) == 2500 and resident() - before < 60


def test_anchors_of_blocks_are_those_of_the_whole():
    """Least grams of windows are found block by block; equal windows have theirs at the same place, and runs end with documents."""
    data = np.frombuffer((prose(77, 12_000) + "a" * 500 + prose(77, 12_000)).encode(), np.uint8)
    hashed = op7_suffix.Hashed(data)
    at = hashed.anchors(100, 32)
    h = ((hashed.sums[32:] - hashed.sums[:-32]) * hashed.down[: len(data) - 31]) >> np.uint64(32)
    rows = np.lib.stride_tricks.sliding_window_view(h, 69)
    assert len(data) > 2 * len(op7_suffix._PLACES) and (at == np.arange(len(rows)) + rows.argmin(1)).all()


def brute1(rows):
    runs, n = {}, {}
    for i, t in rows:
        own, folded = op1_spans.sentences(t or "")
        n[i] = own
        size = [s.count(" ") + 1 for s in folded]
        found = set()
        for k in (1, 2, 3):
            for a in range(len(own) - k + 1):
                if sum(size[a : a + k]) >= op1_spans.LEAST_WORDS[k]:
                    found.add((a, k))
        if 0 < len(own) < 3:
            found.add((0, len(own)))
        for a, k in found:
            # The whole of a short text is a run by itself, apart from runs inside longer ones.
            if sum(size[a : a + k]) >= op1_spans.LEAST_WORDS[k]:
                runs.setdefault((k, tuple(folded[a : a + k])), []).append((i, a))
            if a == 0 and k == len(own) < 3:
                runs.setdefault(("all", tuple(folded)), []).append((i, 0))
    gone = {i: set() for i, _ in rows}
    for (k, words), at in runs.items():
        first = min(at)
        for i, a in at:
            if (i, a) != first:
                gone[i] |= set(range(a, a + len(words)))
    return {i: "".join(s for k, s in enumerate(n[i]) if k not in gone[i]) if n[i] else (t or "") for i, t in rows}


def test_sentence_spans_are_brute_force(spark):
    texts = _corpus() + ["Short one here.", "Short one here.", "short  ONE here."]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.text for r in op1_spans.remove_spans(spark, documents(spark, texts, extra=True).repartition(3)).collect()}
    want = brute1(rows)
    assert {i for i in got if got[i] != want[i]} == set()
    assert op1_spans.remove_spans(spark, documents(spark, [])).count() == 0


def test_spans_of_short_sentences_and_of_scripts_without_spaces(spark):
    han = ["春天来了。花都开了。鸟在唱歌。", "他走进房间。灯还亮着。没有人说话。"]
    long = "".join(chr(0x4E00 + 7 * k) for k in range(60)) + "。"
    texts = [han[0], "Yes. No. Maybe.", "一。" + long, han[0], "甲。" + han[1] + "乙。", "丙。丁。" + han[1], "Why not? yes. no. maybe. Go on.", "二。" + long + "三。", "春天来了。花都开了。别的话。"]
    got = [r.text for r in op1_spans.remove_spans(spark, documents(spark, texts).repartition(3)).orderBy("doc_id").collect()]
    assert got == [*texts[:3], "", texts[4], "丙。丁。", "Why not? Go on.", "二。三。", texts[8]]


def test_sentences_make_up_the_text():
    for t in _corpus():
        if t and t.strip():
            assert "".join(op1_spans.sentences(t)[0]) == t


def brute8(rows, within=2):
    def fingerprint(text):
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
        w = re.findall(rb"[^\x20\x09-\x0D]+", low)
        if not w:
            return 0
        runs = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)]
        h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = {i: fingerprint(t) for i, t in rows}
    root = {i: i for i in fp}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fp)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if (fp[i] ^ fp[j]).bit_count() <= within:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (f"{fp[i]:016x}", find(i)) for i in ids}


def test_simhash_is_brute_force(spark):
    base = [prose(50 + k, 300) for k in range(8)]
    texts = base + [t + " more" for t in base] + [t.replace("ba", "be", 1) for t in base] + [base[0].upper()] + ODD
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op8_simhash.near_duplicates(spark, documents(spark, texts, extra=True).repartition(3)).collect()}
    assert got == brute8(rows)
    assert op8_simhash.near_duplicates(spark, documents(spark, [])).count() == 0


@pytest.mark.parametrize("shard", [2, 100, 40_000])
def test_vantage_point_shards_lose_no_link(spark, shard):
    import numpy as np

    rng = np.random.default_rng(5)
    points = rng.integers(0, 2**63, 600, dtype=np.uint64)
    points[300:] = points[300:] & np.uint64(0xFFFF) | np.uint64(0xABCD << 40)  # hot buckets: most bits are alike
    near = points[rng.integers(0, 600, 900)] ^ (np.uint64(1) << rng.integers(0, 63, 900, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 63, 900, dtype=np.uint64))
    every = np.unique(np.concatenate([points, near]))
    pairs = {(int(a), int(b)) for k, a in enumerate(every) for b in every[k + 1 :][np.bitwise_count(every[k + 1 :] ^ a) <= 2]}
    df = spark.createDataFrame([(int(x),) for x in every.view(np.int64)], "fp long")
    found = op8_simhash.links_between(spark, df, shard=shard).collect()
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for r in found:
        a, b = (int(np.int64(x).view(np.uint64)) for x in (r.a, r.b))
        assert (a ^ b).bit_count() > 0
        root[find(a)] = find(b)
    assert all(find(a) == find(b) for a, b in pairs)


def test_blocks_of_bits_cover_every_pair():
    import numpy as np

    own = op8_simhash.masks()
    assert [len(m) for m in own] == [3, 9, 27] and all(64 - m.bit_count() <= 20 for m in own[-1])
    rng = np.random.default_rng(9)
    for _ in range(500):
        a, b = rng.integers(0, 64, 2)
        x = int(1 << int(a) | 1 << int(b))
        part = next(p for p, m in enumerate(own[0]) if not x & m)
        for level in (1, 2):  # below each bucket that the pair shares there is one that it shares
            part = next(p for p in range(3 * part, 3 * part + 3) if not x & own[level][p])


def test_checks_tell_equal_keys_apart():
    import numpy as np

    from folioscan.llm._common import first_of
    from folioscan.llm._levels import Levels

    key, doc, pos = np.array([7, 7, 7, 7], np.uint64), np.array([1, 2, 3, 4], "<i8"), np.zeros(4, "<i4")
    check = np.array([5, 5, 6, 6], "<u4")
    levels, lost = Levels(["<u8", "<i8", "<i4", "<u4"]), []
    for k in range(4):
        lost += levels.add([c[k : k + 1] for c in (key, doc, pos, check)])[1].tolist()
    assert 3 not in lost and 1 not in lost and 2 in lost
    assert set(first_of(key[:2], doc[:2], pos[:2], np.array([5, 6], "<u4"))[1].tolist()) == set()


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 160)) and got[201] == 200
