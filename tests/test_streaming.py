from lexloom.streaming.ingest import append_to, citations_of, sessions_of, stream_table


def test_citations_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    spark.createDataFrame([(1, "section 7-1"), (2, None)], "id int, t string").write.parquet(src)
    run = lambda: append_to(citations_of(stream_table(spark, src), ["id"], "t"), out, mark).awaitTermination(120)
    run()
    spark.createDataFrame([(3, "§8-2 and chapter 9")], "id int, t string").write.mode("append").parquet(src)
    run()
    run()
    assert sorted((r.id, r.target) for r in spark.read.parquet(out).collect()) == [(1, "7-1"), (3, "8-2"), (3, "ch:9")]


def test_sessions(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:30:00"), (1, "2024-01-01 03:00:00"), (2, "2024-01-01 00:10:00"), (2, "2024-02-01 00:00:00")]
    spark.createDataFrame(rows, "user_id int, ts string").selectExpr("user_id", "cast(ts as timestamp) ts").write.parquet(src)
    append_to(sessions_of(stream_table(spark, src)), out, mark).awaitTermination(120)
    got = {(r.user_id, str(r.start), r.events) for r in spark.read.parquet(out).collect()}
    assert got == {(1, "2024-01-01 00:00:00", 2), (1, "2024-01-01 03:00:00", 1), (2, "2024-01-01 00:10:00", 1)}
