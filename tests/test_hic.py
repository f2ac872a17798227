"""Binary contact files against the triples that they were made of."""

from __future__ import annotations

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline import registry
from strandline.plans import portal
from strandline.sources import hic, text

CHROMS = [("All", 100), ("chr1", 2_000_000), ("chr2", 1_000_000), ("chrX", 500_000)]


def made(seed=1):
    rng = random.Random(seed)
    contacts = {}
    for resolution in (5000, 25000):
        cells = {}
        for _ in range(900):
            a, b = sorted((rng.randint(1, 3), rng.choice([1, 1, 2, 3])))
            x, y = (rng.randrange(CHROMS[k][1] // resolution) for k in (a, b))
            cells[(a, *sorted((x, y)), a) if a == b else (a, x, y, b)] = rng.randint(1, 900)
        contacts[resolution] = [(a, x, b, y, float(v)) for (a, x, y, b), v in cells.items()] + [(0, 1, 0, 2, 7.0)]
    vectors = {(n, k, r): [rng.uniform(0.5, 2) for _ in range(CHROMS[k][1] // r)] for n in ("KR", "VC_SQRT") for k in (1, 2, 3) for r in contacts if (n, k) != ("KR", 3)}
    vectors["KR", 3, 5000] = [float("nan")] * 100
    return contacts, vectors


def expected(contacts, vectors, norms, trans=True):
    out = {}
    for r, cells in contacts.items():
        for a, x, b, y, v in cells:
            for n in norms:
                have = n == "NONE" or ((n, a, r) in vectors and (n, b, r) in vectors)
                if a and have and (trans or a == b):
                    value = v if n == "NONE" else v / (vectors[n, a, r][x] * vectors[n, b, r][y])
                    out[n, r, CHROMS[a][0], x * r, CHROMS[b][0], y * r] = value
    return out


def close(got, expect):
    assert got.keys() == expect.keys()
    assert all((g != g and e != e) or abs(g - e) <= 1e-5 * abs(e) for g, e in ((got[k], expect[k]) for k in got))


@pytest.mark.parametrize("dense,whole,bins", [(False, False, 50), (True, False, 20), (False, True, 7), (True, True, 30)])
def test_triples_of_all_kinds_of_blocks(spark, tmp_path, dense, whole, bins):
    contacts, vectors = made()
    (tmp_path / "E1.hic").write_bytes(hic.encode(CHROMS, contacts, vectors, bins, dense, whole))
    got = hic.read_hic(spark, str(tmp_path), part_bytes=1500)
    rows = {(r["norm"], r["resolution"], r["chrom1"], r["bin1"], r["chrom2"], r["bin2"]): r["counts"] for r in got.collect()}
    close(rows, expected(contacts, vectors, ["NONE", "KR", "VC_SQRT"]))
    assert got.rdd.getNumPartitions() > 10 and {r["accession"] for r in got.select("accession").distinct().collect()} == {"E1"}


def test_parts_of_a_file(spark, tmp_path):
    contacts, vectors = made(2)
    (tmp_path / "E1.hic").write_bytes(hic.encode(CHROMS, contacts, vectors))
    few = hic.read_hic(spark, f"file:{tmp_path}", ["KR"], 5000, ["chr1", "chr2"], trans=False)
    rows = {(r["norm"], r["resolution"], r["chrom1"], r["bin1"], r["chrom2"], r["bin2"]): r["counts"] for r in few.collect()}
    close(rows, {k: v for k, v in expected(contacts, vectors, ["KR"], False).items() if k[1] == 5000 and k[2] in ("chr1", "chr2")})
    assert few.rdd.getNumPartitions() == 2 and hic.read_hic(spark, str(tmp_path), ["SCALE"]).count() == 0


def test_catalog_and_tokens(spark, tmp_path):
    """The catalog is that of the triples; tokens of the binary form are those of the text form."""
    contacts, vectors = made(3)
    del vectors["KR", 3, 5000]
    for name in ("E1", "E2"):
        (tmp_path / f"{name}.hic").write_bytes(hic.encode(CHROMS, contacts, vectors if name == "E1" else {}))
    triples = hic.read_hic(spark, str(tmp_path))
    plain = lambda d: sorted((r["accession"], list(r["resolutions"]), list(r["norms"]), list(r["chroms"])) for r in d.collect())
    assert plain(hic.hic_catalog(spark, str(tmp_path))) == plain(text.contact_catalog(triples))
    info = spark.createDataFrame([("E1", "b1"), ("E2", "b2")], "accession string, biosample string")
    chroms = spark.createDataFrame([("chr2", 0), ("chr1", 1)], "chrom string, ord int")
    tokens = portal.contact_tokens(triples, info, 10_000, chroms, True, 50.0)
    kept = lambda n, e: sum(v > 50 and k[1] == 5000 and k[2] in ("chr1", "chr2") and k[4] in ("chr1", "chr2") for k, v in expected(contacts, e, [n]).items())
    counts = {r["experiment_accession"]: r["count"] for r in tokens.groupBy("experiment_accession").count().collect()}
    assert counts == {"E1": kept("KR", vectors), "E2": kept("NONE", {})}
    assert tokens.where(F.col("chrom1") == "chr1").where(F.col("chrom2") == "chr2").count() == 0


def test_other_files_are_an_error(spark, tmp_path):
    (tmp_path / "x.hic").write_bytes(b"HIC\0" + (9).to_bytes(4, "little") + bytes(200))
    with pytest.raises(Exception, match="version 9"):
        hic.read_hic(spark, str(tmp_path)).count()


@pytest.mark.parametrize("whole,bins", [(True, 7), (False, 50), (False, 1000)])
def test_files_written_by_tasks(spark, tmp_path, whole, bins, monkeypatch):
    """Blocks are packed in tasks, whatever batches they come in, and a file is put together block by block: what is read back is what a file made at once gives."""
    monkeypatch.setattr(hic, "BATCH_ROWS", 64)
    contacts, vectors = made(4)
    chroms = [*CHROMS[:3], ("chrX", 500_000)]
    cells = [(n, a, x, b, y, v if whole else v / 3) for n in ("E1", "E2") for a, x, b, y, v in contacts[5000] if n == "E1" or a == 1]
    rows = spark.createDataFrame(cells, "accession string, one int, x long, two int, y long, counts double").repartition(5)
    kept = {k: v for k, v in vectors.items() if k[2] == 5000}
    lists = spark.createDataFrame([("E1", n, k, v) for (n, k, _), v in kept.items()] + [("E3", "KR", 1, [1.0])], "accession string, norm string, chrom int, values array<double>")
    path = str(tmp_path / "made")
    hic.write_hic(rows, lists, path, chroms, 5000, bins, whole)
    rows_of = lambda at: {(r["accession"], r["norm"], r["chrom1"], r["bin1"], r["chrom2"], r["bin2"]): r["counts"] for r in hic.read_hic(spark, at, part_bytes=900).collect()}
    (tmp_path / "once").mkdir()
    for n, v in (("E1", kept), ("E2", {})):
        (tmp_path / "once" / f"{n}.hic").write_bytes(hic.encode(chroms, {5000: [c[1:] for c in cells if c[0] == n]}, v, whole=whole))
    got = rows_of(path)
    close(got, rows_of(str(tmp_path / "once")))
    assert {k[0] for k in got} == {"E1", "E2"} and sorted(p.name for p in (tmp_path / "made").iterdir()) == ["E1.hic", "E2.hic"]


def test_partitions_name_runs_of_the_index(tmp_path):
    """What the driver plans is a place and a number for each run, however many blocks it has."""
    cells = [(1, 2 * k, 1, 2 * k, 1.0) for k in range(3000)]
    (tmp_path / "E1.hic").write_bytes(hic.encode([("All", 1), ("chr1", 100_000)], {10: cells}, {}, 2))
    for part_bytes, n in ((1 << 20, 1), (2000, None)):
        parts = hic.HicReader(str(tmp_path), None, None, None, True, part_bytes).partitions()
        assert all(len(p.blocks) == 2 for p in parts) and sum(p.blocks[1] for p in parts) == 3000 and n in (None, len(parts))
    with hic.opened(str(tmp_path / "E1.hic")) as file:
        sizes = [hic.index(file, *p.blocks)["size"] for p in parts]
    assert all(s[:-1].sum() < 2000 for s in sizes) and all(s.sum() >= 2000 for s in sizes[:-1])


#: Around the ends of 16, 24, 32 and 53 bits, two of them divided by 2.25 and by 1.5 to another number if rounded first, and a count that is not known.
SIZES = [0, 3, 29_999, 30_000, 32_767, 32_768, -32_767, -32_768, -40_000, 2**24 - 1, 2**24 + 1, 33_554_435, -(2**24) - 1, 2**31 + 129, 2**32 + 257, 2**48 + 2**24 + 1, 2**53 - 1, 1 - 2**53, None]


@pytest.mark.parametrize("bins", [1, 4, 1000])
def test_whole_counts_of_any_size(spark, tmp_path, bins):
    """No count is too large for a file: what is read back is the count, or the exact count divided, rounded once."""
    cells = [("E1", a, 2 * k, b, 2 * k + 1 + j, v) for a, b in ((1, 1), (1, 2)) for k, v in enumerate(SIZES) for j in range(2)]
    rows = spark.createDataFrame(cells, "accession string, one int, x long, two int, y long, counts long").repartition(3)
    lists = {k: [(1 + (k + j) % 3) / 2 for j in range(2 * len(SIZES) + 2)] for k in (1, 2)}
    vectors = spark.createDataFrame([("E1", "KR", k, v) for k, v in lists.items()], "accession string, norm string, chrom int, values array<double>")
    hic.write_hic(rows, vectors, str(tmp_path / "made"), CHROMS[:3], 10, bins, True)
    got = {(r["norm"], r["chrom2"], r["bin1"], r["bin2"]): r["counts"] for r in hic.read_hic(spark, str(tmp_path / "made"), part_bytes=300).collect()}
    assert len(got) == 2 * len(cells)
    for _, a, x, b, y, v in cells:
        at = (f"chr{b}", 10 * x, 10 * y)
        expect = [float("nan")] * 2 if v is None else [float(np.float32(v)), float(np.float32(v / (lists[a][x] * lists[b][y])))]
        assert [str(got["NONE", *at]), str(got["KR", *at])] == [str(e) for e in expect], v


def test_counts_are_kept_short_where_they_fit():
    """Only a block with a count that 16 bits do not hold has longer ones, and a count stands once if 32 bits hold it."""
    x, y = np.array([5, 7, 5]), np.array([2, 2, 9])
    for v, entries, kind in (([1, -32_767, 32_767], 3, 0), ([1, 2, 32_768], 3, 1), ([1, 2, 2**24], 3, 1), ([1, 2**24 + 1, 3], 4, 1)):
        block = hic.pack(x, y, np.array(v), True)
        head = zlib.decompress(block)
        assert (int.from_bytes(head[:4], "little"), head[12]) == (entries, kind)
        assert [c.tolist() for c in hic.decode(block)] == [x.tolist(), y.tolist(), v]
    with pytest.raises(ValueError, match="block_bins"):
        hic.pack(np.array([0, 40_000]), np.array([0, 0]), np.array([1, 1]), True)


def test_contacts_of_many_lines(spark, tmp_path):
    """hic_matrices has every pair of suppliers: those with 30,000 and more, and those without a quantity."""
    amounts = [[14_999, 15_000], [15_000, 15_000, 15_000], [16_384, 16_384], [2, 3, 5], [9_000_000, 9_000_001], [1_500_000_000, 1_600_000_001], [None, 4], [None, None]]
    lines = [(10 * rep + k, (3 * k + 7 * n) % 20, n, None if q is None else float(q)) for k, qs in enumerate(amounts) for n, q in enumerate(qs) for rep in (0, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, k % 7) for k in range(20)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    columns = ["accession", "norm", "chrom1", "bin1", "chrom2", "bin2", "counts"]
    got = sorted((tuple(r) for r in registry.queries()["hic_matrices"](spark, str(tmp_path)).select(columns).collect()), key=str)
    assert got == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()['hic_matrices']})").fetchall(), key=str)
    pairs = {tuple(sorted((a[1], b[1]))) for a in lines for b in lines if a[0] == b[0] and a[2] < b[2]}
    assert len(got) == len(pairs) and sum(r[-1] is None for r in got) == 2 and sum((r[-1] or 0) > 2**31 for r in got) > 0
