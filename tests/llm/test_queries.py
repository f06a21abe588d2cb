import pytest

from lexloom.llm import registry

COLUMNS = {
    "p1_found": [("rec_table", "string"), ("rec_id", "string"), ("zone", "string")],
    "p3_found": [("section_id", "string"), ("zone", "string")],
    "p4_found": [("rec_table", "string"), ("rec_id", "string"), ("zone", "string")],
    "p7_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    "p8_found": [("doc_id", "bigint"), ("item_id", "bigint")],
    "p9_found": [("doc_a", "bigint"), ("doc_b", "bigint")],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, sf, name):
    df = registry.queries()[name](spark, sf)
    rows = df.collect()
    assert df.dtypes == COLUMNS[name] and rows
    if name != "p7_ids":
        assert len(rows) == len(set(rows))


def test_p4_whole(spark, tmp_path):
    """Every body and catchline comes out of p4_mended once; those of the zones that hold citations alone as they are, whatever their lines look like."""
    notes = [("hrs:1-1", "history", "L 1967, c 210, §19\n24\nam L 1969, c 59, §24"), ("hrs:1-1", "auth", "(Auth: 606-2\n91\n124-222)"), ("hrs:1-1", "imp", "the har-\nbor act"), ("hrs:1-2", "imp", None), ("hrs:1-3", "auth", "")]
    prose = [("hrs:1-1", "operative", "The court shall hear it\n24\nwithin ten days."), ("hrs:1-1", "source_note", "[Eff 2/11/87]"), ("hrs:1-2", None, "The court."), ("hrs:1-3", "operative", None)]
    spark.createDataFrame(notes + prose + notes[:1] + prose[:1], "section_id string, zone string, body string").write.parquet(f"{tmp_path}/zones.parquet")
    spark.createDataFrame([("hrs:1-1", "Hearings"), ("hrs:1-2", None), ("hrs:1-1", "Hearings")], "id string, catchline string").write.parquet(f"{tmp_path}/sections.parquet")
    q = registry.queries()
    rows = [((r.rec_table, r.rec_id, r.zone), r.text, [r.broken, r.misread, r.headers, r.pages]) for r in q["p4_mended"](spark, str(tmp_path)).collect()]
    got = {k: (text, traces) for k, text, traces in rows}
    assert len(rows) == len(got) == len(notes) + len(prose) + 2
    assert all(got["zones", i, z] == (text, [0, 0, 0, 0]) for i, z, text in notes)
    assert got["zones", "hrs:1-1", "operative"] == ("The court shall hear it within ten days.", [0, 0, 0, 1])
    assert got["sections", "hrs:1-1", ""] == ("Hearings", [0, 0, 0, 0])
    assert [tuple(r) for r in q["p4_found"](spark, str(tmp_path)).collect()] == [("zones", "hrs:1-1", "operative")]
