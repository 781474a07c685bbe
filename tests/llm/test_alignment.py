"""Token alignment against a walk over both token lists."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

from adstrata.llm import alignment

FOLDER = alignment.FOLDER


def walk(ids_a, ids_b):
    """Groups by merging the two sides' ends."""
    a, b = alignment.sides(FOLDER)
    groups, i, j, end_a, end_b = [], 0, 0, 0, 0
    while i < len(ids_a):
        groups.append(([], []))
        while True:
            if end_a <= end_b and (end_a != end_b or not groups[-1][0]):
                groups[-1][0].append(ids_a[i])
                end_a += len(a.spelled[ids_a[i]])
                i += 1
            else:
                groups[-1][1].append(ids_b[j])
                end_b += len(b.spelled[ids_b[j]])
                j += 1
            if end_a == end_b and groups[-1][0] and groups[-1][1]:
                break
    return groups


def brute(rows):
    from tokenizers import Tokenizer

    a, b = alignment.sides(FOLDER)
    reference = Tokenizer.from_file(f"{FOLDER}/{alignment.A_FILE}")
    reference.encode_special_tokens = True
    found, counts = [], Counter()
    for _, text in rows:
        groups = []
        if text:
            ids_a = reference.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode([text])[0]
            data = (" " + text).encode()
            if a.spells(ids_a, data) and b.spells(ids_b, data):
                groups = walk(ids_a, ids_b)
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        counts.update(set(links))
        found.append((groups, links))
    most = defaultdict(int)
    for (x, _), c in counts.items():
        most[x] = max(most[x], c)
    out = []
    for (i, _), (groups, links) in zip(rows, found, strict=True):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((
            i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
            sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


def texts():
    rng = random.Random(8)
    rows = [
        (0, None), (0, ""), (None, "plain words"), (1, "<|endoftext|> and <s> </s> <unk> <0x41>"), (2, "a  b   c \n\n d\t"),
        (3, "naïve café — “quotes” 漢字かな 🙂👩‍👩‍👧 ñandú"), (4, "▁ is a piece of its own"), (5, " leading and trailing  "), (6, "\x00\x01 control"),
        (7, "aaaa" * 3000 + "b" * 4001), (8, "1234567890" * 50), (9, "don't we'll I'M they've 'tis"),
        (10, " ".join(rng.choice(["the", "of", "Quelle", "überall", "straße", "él"]) for _ in range(40_000))), (11, "x"),
    ]
    pool = "abc deé ü\n.,!?0189ßñ€漢🙂'  "
    rows += [(100 + i, "".join(rng.choices(pool, k=rng.randint(1, 60)))) for i in range(150)]
    return rows + rows[10:14]


def test_align(spark, monkeypatch):
    rows = texts()
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, n_a int, block string")
    expected = brute(rows)
    done = alignment.align(df)
    assert done.columns == ["doc_id", *alignment.NUMBERS, "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in done.collect()), key=str) == expected
    assert alignment.align(df.limit(0)).count() == 0


def test_pieces_give_the_tokens_of_the_whole():
    a, b = alignment.sides(FOLDER)
    for _, text in texts():
        if text:
            parts = alignment.pieces_of(text, 7)
            assert " ".join(parts) == text
            assert sum(a.encode([" " + p for p in parts]), []) == a.encode([" " + text])[0]
            assert sum(b.encode(parts), []) == b.encode([text])[0]


def test_small_slices_and_blocks(spark, monkeypatch):
    rows = [r for r in texts() if r[1]][:40]
    ids_a, ids_b = alignment.encoded([t for _, t in rows], FOLDER)
    whole = alignment.Block(ids_a, ids_b, FOLDER)
    monkeypatch.setattr(alignment, "SLICE", 3)
    sliced = alignment.Block(ids_a, ids_b, FOLDER)
    assert np.array_equal(whole.links, sliced.links) and np.array_equal(whole.uses, sliced.uses)
    assert whole.uses.sum() == whole.n_links.sum()


def test_pointer_jumping():
    ends_a, ends_b = np.array([2, 3, 7, 9, 12]), np.array([1, 3, 5, 8, 9, 12])
    label = alignment.terminals(ends_a, ends_b)
    assert label[:5].tolist() == [6, 6, 9, 9, 10] and label[5:].tolist() == [6, 6, 9, 9, 9, 10]
    assert alignment.terminals(np.empty(0, np.int64), np.empty(0, np.int64)).tolist() == []


def test_readers_of_blocks_hold_few_of_them(spark, monkeypatch):
    """A reader takes up to 4096 rows of a row group at once, so a file of all blocks of a task must have many."""
    import glob

    import pyarrow.parquet as pq

    monkeypatch.setattr(alignment, "BLOCK_ROWS", 1)
    rows = [r for r in texts() if r[1]][:30]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted((tuple(r) for r in alignment.align(df).collect()), key=str) == brute(rows)
    blocks = alignment._blocks(df, "doc_id", "text", FOLDER)
    files = [pq.ParquetFile(f) for path in blocks.inputFiles() for f in glob.glob(path.removeprefix("file:"))]
    sizes = [f.metadata.row_group(i).num_rows for f in files for i in range(f.metadata.num_row_groups)]
    assert sum(sizes) == 30 and max(sizes) <= 8
    # A link takes no more bytes than its numbers need.
    assert all(len(b.at) <= 2 * sum(b.per_doc) for b in blocks.select("at", "per_doc").collect())


def test_packed_numbers():
    for most in (0, 1, 255, 256, 65_535, 65_536, 2**32 - 1, 2**32, 2**62):
        data = alignment.packed(np.array([most, 0, most // 2]))
        assert alignment.unpacked(data, 3).tolist() == [most, 0, most // 2]
        assert len(data) == 3 * next(n for n in (1, 2, 4, 8) if most < 2 ** (8 * n))
    assert alignment.unpacked(alignment.packed(np.empty(0, np.int64)), 0).tolist() == []
