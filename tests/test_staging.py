import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom import staging
from tagloom.learn import blocks, word2vec
from tagloom.plans import queries
from tagloom.staging import Generations, discard, settle, stage


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("write", [stage, lambda df: Generations("rows").advance(df)])
def test_what_a_staged_write_moved_goes(spark, write):
    before = shuffle_files(spark)
    table = write(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert sorted(map(tuple, table.collect())) == [(k, 1000 // 7 + (k < 1000 % 7)) for k in range(7)]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_discarded_tables_are_gone(spark):
    kept, gone = stage(spark.range(3)), stage(spark.range(4))
    path = gone.inputFiles()[0]
    discard(spark, gone)
    assert kept.count() == 3
    with pytest.raises(Exception, match="[Pp]ath|exist"):
        spark.read.parquet(path).count()


def raw_tables(spark, path):
    talk = [(1, 0, "u", "One two.\n\nThree"), (1, 1, "v", "four, 5"), (2, 0, "u", "Two one")]
    spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    docs = [(i, f"the Dog {i}\nruns \N{LATIN SMALL LETTER E WITH ACUTE}t\N{LATIN SMALL LETTER E WITH ACUTE} {i}.") for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return talk, docs


def test_raw_files_are_compressed(spark, tmp_path):
    """Raw files of the token tables take little disk, and read as they were written."""
    path = str(tmp_path)
    _, docs = raw_tables(spark, path)
    raw = queries._write_raw(spark, path, "HDT", "B")
    assert all(f.endswith(".gz") for f in spark.read.text(raw).inputFiles())
    n = sum(r["n"] for r in queries.raw_minimal_scan(spark, path).collect())
    assert n == sum(len(t.replace(".", " .").split()) for _, t in docs)


def test_raw_files_go_after_their_ids_are_staged(spark, tmp_path, monkeypatch):
    path, written = str(tmp_path), []
    raw_tables(spark, path)
    write = queries._write_raw
    monkeypatch.setattr(queries, "_write_raw", lambda *a: written.append(write(*a)) or written[-1])
    rows = queries.multi_file_corpus(spark, path)
    for raw in written:
        with pytest.raises(Exception, match="[Pp]ath|exist"):
            spark.read.text(raw).count()
    got = sorted((r["SENT_ID"], r["n"], r["least"]) for r in rows.collect())
    assert got[:4] == [(1, 3, "."), (2, 1, "Three"), (3, 3, ","), (4, 2, "Two")] and len(got) == 4 + 80


def test_settled_tables_leave_only_the_result(spark):
    kept, made = stage(spark.range(3)), []
    table = settle(spark, lambda: made.append(stage(spark.range(9))) or made[0].where("id > 4"))
    assert sorted(r[0] for r in table.collect()) == [5, 6, 7, 8] and kept.count() == 3
    with pytest.raises(Exception, match="[Pp]ath|exist"):
        spark.read.parquet(made[0].inputFiles()[0]).count()


def staged_names(spark):
    return [p.rsplit("/", 1)[1].split("-")[0] for p in staging._written.get(spark.sparkContext.applicationId, [])]


def test_matrices_go_before_the_next_is_made(spark, tmp_path):
    """Facts of both matrices stay; pairs and marginals do not."""
    path = str(tmp_path)
    raw_tables(spark, path)
    before = staged_names(spark)
    rows = queries.ppmi_rows(spark, path)
    assert sorted(staged_names(spark)[len(before):]) == ["rows", "rows"]
    assert {r["arch"] for r in rows.collect()} == {"sg", "cb"}


def test_factorisation_keeps_no_old_step(spark, monkeypatch):
    """Krylov steps leave their last basis, images and product, whatever their number."""
    monkeypatch.setattr(blocks, "BLOCK_FORMS", 50)
    entries = [(a, b, 1.0 + (a * b) % 7) for a in range(120) for b in range(120) if (a + 3 * b) % 5 < 2]
    placed = spark.createDataFrame([(a // 50, a % 50, b // 50, b % 50, m) for a, b, m in entries], "rb int, r int, cb int, c int, m double")
    sizes = spark.createDataFrame([(0, 50), (1, 50), (2, 20)], "block int, n long")
    matrix = stage(blocks.packed(placed, sizes), "matrix")
    before = len(staged_names(spark))
    found, residual = blocks.leading(matrix, sizes, 2, tolerance=1e-9, spare=1, most=30)
    assert residual <= 1e-9 and sorted(staged_names(spark)[before:]) == ["basis", "images", "product"]
    dense = np.zeros((120, 120))
    for a, b, m in entries:
        dense[a, b] = m
    u, sigma, _ = np.linalg.svd(dense)
    got = {r["block"]: np.frombuffer(r["data"]).reshape(-1, 2) for r in found.collect()}
    mine, want = np.vstack([got[k] for k in range(3)]), u[:, :2] * np.sqrt(sigma[:2])
    assert np.allclose(mine @ mine.T, want @ want.T, atol=1e-6)


def test_skipgram_drops_its_pairs(spark):
    sents = spark.createDataFrame([("A", i, ["a", "b", f"c{i % 9}", "d"]) for i in range(60)], "CORP string, SENT_ID long, TOKENS array<string>")
    before = len(staged_names(spark))
    rows = word2vec.train(sents, "sg", word2vec.Settings(dim=3, epochs=1))
    assert "pairs" not in staged_names(spark)[before:] and rows.count() == 12
