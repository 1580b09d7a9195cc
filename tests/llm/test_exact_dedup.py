import duckdb
import pytest

from lexiflow.llm import exact_dedup as X
from tests.llm.helpers import odd_docs, odd_texts


def test_report_equals_sql(spark):
    rows = [(i, t) for i, t in odd_texts() if i is not None]
    rows = list(dict(rows).items()) + [(100 + i, "hot  text") for i in range(300)] + [(90, "hot text")]
    docs = odd_docs(spark, rows)
    got = sorted(map(tuple, X.report(docs).collect()))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert got == sorted(con.execute(X.REPORT_SQL).fetchall())
    assert X.report(docs.limit(0)).count() == 0


def test_null_and_repeated_ids(spark):
    found = X.report(odd_docs(spark))
    kept = found.filter("kept")
    assert kept.select("text_sha256").distinct().count() == kept.count() == found.select("text_sha256").distinct().count()
    assert found.count() == len(odd_texts())


def test_index_persists_over_batches(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    index = X.DigestIndex(spark, path, buckets=4)
    first = X.drop_copies(odd_docs(spark, [(5, "a b"), (3, "a  b"), (9, "c")]), index)
    assert {r.doc_id for r in first.collect()} == {3, 9}
    again = X.DigestIndex(spark, path, buckets=4)
    rows = {r.doc_id: r for r in X.decide(odd_docs(spark, [(1, "a b"), (2, "new"), (2, "new")]), again).collect()}
    assert rows[1].keep_id == 3 and not rows[1].kept and rows[2].keep_id == 2
    assert again.read().count() == 3
    plan = odd_docs(spark).select(X.digest().alias("digest")).hint("merge").join(
        again.read(), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # the index isn't shuffled


def test_drop_copies_keeps_columns_and_one_row(spark):
    docs = odd_docs(spark)
    out = X.drop_copies(docs, X.DigestIndex(spark))
    assert out.columns == docs.columns
    texts = {" ".join((t or "").replace("\x1c", "\x01").split(" ")) for _, t in odd_texts()}
    assert 0 < out.count() < len(odd_texts()) and len(texts)
    assert X.drop_copies(docs.limit(0), X.DigestIndex(spark)).count() == 0


def kept_ids(found):
    return sorted(r.doc_id for r in found.filter("kept").collect())


def fresh(spark, texts, start=0):
    return odd_docs(spark, [(start + i, t) for i, t in enumerate(texts)])


def test_reopened_with_other_settings(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    texts = [f"text number {i}" for i in range(200)]
    index = X.DigestIndex(spark, path, buckets=4)
    assert len(kept_ids(X.decide(fresh(spark, texts), index))) == 200
    index.close()
    with pytest.raises(ValueError, match="has 4 buckets, not 8"):
        X.DigestIndex(spark, path, buckets=8)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        again = X.DigestIndex(spark, path)
        found = X.decide(fresh(spark, texts + ["new"], 1000), again)
        assert again.buckets == 4 and found.count() == 201 and kept_ids(found) == [1200]
        assert again.read().count() == again.read().select("digest").distinct().count() == 201
        again.close()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_digests_outside_their_buckets_are_refused(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    index = X.DigestIndex(spark, path, buckets=4)
    X.decide(fresh(spark, [f"t{i}" for i in range(50)]), index)
    index.close()
    layout = tmp_path / "index" / "layout.json"
    layout.write_text(layout.read_text().replace("4", "8"))
    (tmp_path / "index" / ".layout.json.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="outside their buckets"):
        X.DigestIndex(spark, path)


def test_batch_run_again_is_decided_as_before(spark, tmp_path):
    index = X.DigestIndex(spark, f"file://{tmp_path}/index", buckets=4)
    X.decide(fresh(spark, ["a", "b"]), index, batch_id="one")
    docs = fresh(spark, ["b", "c", "c", "d"], 10)
    first = X.decide(docs, index, batch_id="two")
    second = X.decide(docs, index, batch_id="two")  # its result was lost after the append
    assert kept_ids(first) == kept_ids(second) == [11, 13]
    assert sorted(r.doc_id for r in X.drop_copies(docs, index, batch_id="two").collect()) == [11, 13]
    assert kept_ids(X.decide(docs, index, batch_id="three")) == []
    assert [b["batch"] for b in index.batches()] == ["one", "two", "three"] and index.read().count() == 4
    index.close()


def test_what_a_failed_writer_left_is_not_read(spark, tmp_path, monkeypatch):
    index = X.DigestIndex(spark, f"file://{tmp_path}/index", buckets=4)
    docs = fresh(spark, ["a", "b"])
    with monkeypatch.context() as m:
        m.setattr(index, "_create", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError, match="driver lost"):
            X.decide(docs, index, batch_id="one")
    assert spark.table(index.name).count() == 2 and index.read().count() == 0
    assert kept_ids(X.decide(fresh(spark, ["b"], 7), index, batch_id="other")) == [7]
    assert kept_ids(X.decide(docs, index, batch_id="one")) == [0]
    index.close()


def test_two_writers_at_once(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/index"
    one, two = X.DigestIndex(spark, path, buckets=4), X.DigestIndex(spark, path)
    create, seen = one._create, []

    def late(file, text):
        if not seen:  # the other writer commits between this one's look-up and its log file
            seen.append(kept_ids(X.decide(fresh(spark, ["a", "x"], 50), two, batch_id="two")))
        return create(file, text)

    monkeypatch.setattr(one, "_create", late)
    found = X.decide(fresh(spark, ["a", "b"]), one, batch_id="one")
    assert seen == [[50, 51]] and kept_ids(found) == [1]
    assert one.read().count() == 3
    one.close()
    two.close()


def test_no_catalog_tables_left_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    X.report(odd_docs(spark)).count()
    assert {t.name for t in spark.catalog.listTables()} == before
