"""Filter audits, packing along a curve and fill-in-middle against plain versions, and on edge cases."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from billweave.llm import curve_packing, fill_in_middle, filter_audit
from conftest_llm import EDGES, SCHEMA

BYTES = public_tokenizers.path("byte_bpe_50k.json")


# Filter audits


def test_lehmer_ranks_number_the_orders():
    assert [filter_audit.lehmer_rank(order, 5) for order in permutations(range(5))] == list(range(120))
    assert filter_audit.lehmer_rank((1,), 5) == 24 and filter_audit.lehmer_rank((1, 0), 5) == 24


def test_intervals_cover_each_failing_mask_once_an_order():
    for mask in range(32):
        removed = np.zeros((5, 6, 121), dtype=int)
        for m, f, step, rank, sign in filter_audit.removal_ends(5):
            if m == mask:
                removed[f, step, rank:] += sign
        for rank, order in enumerate(permutations(range(5))):
            gone = next(((f, s) for s, f in enumerate(order, 1) if mask >> f & 1), None)
            found = [tuple(x) for x in np.argwhere(removed[:, :, rank])]
            assert found == ([gone] if gone else [])


def plain_audit(rows, labels):
    fails = []
    for k, text, part in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        first = min((i for i, t, _ in rows if i is not None and (t or "") == text), default=None)
        fails.append((
            part or "",
            (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
             bool(re.search(r"[#$%&*|]", text)), k is not None and k > first),
            labels.get(k, (0, 0)),
        ))
    out = {}
    for part in {p for p, _, _ in fails}:
        docs = [(f, label) for p, f, label in fails if p == part]
        for order in permutations(range(5)):
            name, left = "".join("ABCDE"[i] for i in order), docs
            for step, i in enumerate(order, 1):
                removed = [d for d in left if d[0][i]]
                left = [d for d in left if not d[0][i]]
                out[part, name, step] = [
                    len(left), len(removed), sum(d[0][i] for d in docs) - len(removed),
                    sum(d[0] == tuple(j == i for j in range(5)) for d in docs),
                    sum(d[1][0] == 1 for d in removed), sum(d[1][1] == 1 for d in removed),
                ]
    for (part, name, step), row in out.items():
        row.append(sum(r[1] for (p, n, s), r in out.items() if p == part and n[s - 1] == name[step - 1]))
    return {key: tuple(row) for key, row in out.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, mask int, _part string")
    known = spark.createDataFrame([(k, *v) for k, v in labels.items()], "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(docs, known.unionByName(known)).collect()
    assert len(got) == len({tuple(r)[:3] for r in got})
    return {tuple(r)[:3]: tuple(r)[3:] for r in got}


def test_filter_audit_equals_running_each_order(spark):
    rng = random.Random(5)
    long_ = " ".join(f"w{k}" for k in range(220))
    bits = ["", long_, " a" * 300, " THE BIG", " 5%", " été\x0b\x85"]
    rows = [(k, "".join(rng.sample(bits, rng.randint(1, 3))), rng.choice(["s", "t", None])) for k in range(60)]
    rows += [(None, long_, "s"), (None, long_, "t"), (7, long_, "s"), (7, long_, "s"), (3, None, ""), (4, None, None)]
    labels = {k: (rng.randint(0, 1), rng.choice([0, 1, None])) for k in range(0, 50, 2)} | {9: (None, None)}
    assert audited(spark, rows, labels) == plain_audit(rows, labels)


def test_filter_audit_edges(spark):
    rows = [(k, text, "only") for k, text in EDGES]
    assert audited(spark, rows, {}) == plain_audit(rows, {})
    assert audited(spark, [(1, "x", "s")][:0], {}) == {}
    with pytest.raises(ValueError):
        filter_audit.audit(spark.range(1), "BA")


# Packing along a curve


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 5), (3, 3), (4, 2)])
def test_hilbert_keys_visit_each_place_by_single_steps(dimensions, bits):
    places = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
    keys = curve_packing.hilbert_keys(places, bits)
    assert sorted(keys) == list(range(len(places)))
    assert (np.abs(np.diff(places[np.argsort(keys)], axis=0)).sum(1) == 1).all()


@functools.cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES)


def library_ids(text):
    return library().encode(text or "", add_special_tokens=False).ids


def check_packed(spark, rows, limit):
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], f"{SCHEMA}, n int, at string")
    got = curve_packing.pack_along_curve(docs, BYTES, limit).collect()
    sequences, texts = {}, []
    for r in got:
        assert len(r.ids) == 4 * r.length > 0
        sequences.setdefault(r.sequence_id, []).append(r)
    lengths = []
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces[:-1]]).tolist()
        lengths.append(sum(r.length for r in pieces))
    assert max(lengths, default=0) <= limit and all(n == limit or n & (n - 1) == 0 for n in lengths)
    assert sum(n < limit for n in lengths) <= limit.bit_length()
    assert sorted(sequences) == list(range(len(sequences)))
    # Along the line, each document follows the one before it, from its first id to its last.
    line = [r for s in sorted(sequences) for r in sequences[s]]
    for r in line:
        texts += [(r.doc_id, [])] if r.start == 0 else []
        assert r.start == len(texts[-1][1]) and r.doc_id == texts[-1][0]
        texts[-1][1].extend(np.frombuffer(r.ids, "<u4").tolist())
    want = [(k, library_ids(t) + [1]) for k, t in rows]
    assert sorted(texts, key=str) == sorted(want, key=str)
    assert [r.curve for r in line] == sorted(r.curve for r in line)
    assert all(r.doc_tokens == len(ids) for r, ids in zip([r for r in line if r.start == 0], (t[1] for t in texts), strict=True))
    return line


def test_pieces_hold_every_id_once(spark):
    rng = random.Random(3)
    words = ["tok", "ens", " ", "\n\n", "é", "漢字", "🙂", "'s", "12", "<|endoftext|>", "\x85", "ſ", "…", "don't "]
    rows = [(k, "".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for k in range(300)]
    for limit in (64, 2048):
        check_packed(spark, rows + [(900 + k, rows[5][1]) for k in range(100)], limit)


def test_packing_edges(spark, empty):
    check_packed(spark, EDGES, 2048)
    check_packed(spark, [(1, None)], 2048)
    assert curve_packing.pack_along_curve(empty, BYTES).count() == 0


def test_neighbours_on_the_curve_are_alike(spark):
    rng = random.Random(8)
    kinds = [[f"{chr(97 + k)}{rng.randint(0, 99)}" for _ in range(40)] for k in range(4)]
    rows = [(k, " ".join(rng.choice(kinds[k % 4]) for _ in range(60))) for k in range(400)]
    line = check_packed(spark, rows, 1024)
    order = [r.doc_id for r in line if r.start == 0]
    alike = np.mean([a % 4 == b % 4 for a, b in zip(order, order[1:])])
    assert alike > 0.6  # a quarter by chance


# Fill in the middle


def test_skip_list_reaches_each_rank():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("ab\nñ漢\r 🙂") for _ in range(rng.randint(1, 80)))
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        widths = fill_in_middle.line_widths(text)
        assert widths.tolist() == [len(x) for x in lines]
        found = fill_in_middle.SkipList(widths)
        assert [found.code_points(k) for k in range(len(lines) + 1)] == np.cumsum([0, *map(len, lines)]).tolist()
    many = fill_in_middle.SkipList(np.full(100_000, 3))
    assert many.code_points(77_777) == 233_331 and len(many.lanes) < 33
    assert sum(len(units) for units, _, _ in many.lanes) < 220_000


def plain_cut(k, text):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    digest = hashlib.sha256(f"7:{'' if k is None else k}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or re.search("<[PSM]>", text):
        return len(lines), "plain", None, None, text or ""
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    spm = h[3] % 100 < 50
    return len(lines), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_cutting_a_list_of_lines(spark):
    rng = random.Random(2)
    bits = ["a", "\n", "\r\n", "漢🙂", "<", "S>", "P", "M>", "<", ">", "two words", "\x85"]
    rows = [(k, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for k in range(400)] + EDGES
    rows += [(1000, "<P"), (1001, "a\nb<S"), (1002, "<M>\n"), (None, "x\ny\nz\n"), (None, None)]
    docs = spark.createDataFrame([(*r, 3, "c") for r in rows], f"{SCHEMA}, n int, form string")
    made = fill_in_middle.transform(docs)
    back = made.withColumn("restored", fill_in_middle.restored(F.col("output"), F.col("form")))
    got = sorted((tuple(r) for r in back.collect()), key=str)
    assert got == sorted(((k, *plain_cut(k, t), t or "") for k, t in rows), key=str)


def test_rates_and_empty_table(spark, empty):
    assert fill_in_middle.transform(empty).count() == 0
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc").alias("text"))
    forms = lambda **a: {r[0]: r[1] for r in fill_in_middle.transform(docs, **a).groupBy("form").count().collect()}
    assert set(forms(percent=0)) == {"plain"} and set(forms(spm_percent=100)) == {"spm"}
    some = forms(percent=50)
    assert 230 < some["plain"] < 370 and abs(some["psm"] - some["spm"]) < 80
