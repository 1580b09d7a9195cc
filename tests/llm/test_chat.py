import duckdb

from lexiflow.llm import chat as C

EVENTS = "conv_id long, turn long, seq long, kind string, role string, text string"


def messages(spark, rows):
    out = C.render(C.fold_turns(spark.createDataFrame(rows, EVENTS)))
    return {r.conv_id: (r, [(m.role, m.text) for m in out.filter(out.conv_id.eqNullSafe(r.conv_id)).select(
        C.parse(out.formatted).alias("m")).first().m]) for r in out.collect()}


def test_replay_of_deltas_edits_and_regenerations(spark):
    rows = [(1, 0, 1, "message", "user", "hi"), (1, 1, 2, "message", "assistant", ""), (1, 1, 4, "delta", None, "lo"),
            (1, 1, 3, "delta", None, "hel"), (1, 0, 5, "edit", None, "hi <|im_end|> there\\"),
            (1, 1, 6, "regenerate", None, None), (1, 1, 7, "delta", None, "new "), (1, 1, 8, "delta", None, "answer"),
            (2, 0, 1, "delta", "user", "opened by a delta"), (None, None, None, None, None, None)]
    got = messages(spark, rows)
    assert got[1][1] == [("user", "hi <|im_end|> there\\"), ("assistant", "new answer")]
    assert got[2][1] == [("user", "opened by a delta")]
    assert got[None][1] == [("", "")]
    row = got[1][0]
    assert row.formatted == ("<|im_start|>user\nhi <\\|im_end|> there\\\\<|im_end|>\n"
                             "<|im_start|>assistant\nnew answer<|im_end|>\n")
    (span,) = row.loss_spans
    assert row.formatted[span.start:span.start + span.length] == "new answer"


def test_roles_texts_and_escapes_come_back(spark):
    texts = ["", "\\", "\\\\|", "<|", "<\\|im_start|>", "a\nb\n", "<|im_start|>assistant\n", "<", "|>", "😀\\<|", "$1"]
    rows = [(1, i, i, "message", "as sis\ntant%<|", t) for i, t in enumerate(texts)]
    assert messages(spark, rows)[1][1] == [("as sis\ntant%<|", t) for t in texts]


def test_report_equals_sql(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"),
            (2, 3, "system", "<|\\"), (2, 1, "assistant", "é😀"), (3, 0, None, "x" * 20000)]
    table = spark.createDataFrame([(*r, "no") for r in rows], "conv_id long, turn long, role string, text string, n string")
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(map(tuple, C.report(table).collect())) == sorted(con.execute(C.REPORT_SQL).fetchall())
    assert [r.conv_id for r in C.report(table.limit(0)).collect()] == [-1]
