from lexloom.plans import quality as P


def test_all_rules(spark, tmp_path):
    """Rules with some of the zones, brackets and nested parentheses are looked at too."""
    zones = {
        "har:1-1-1": {"operative": "(a) The port (see (1)).", "source_note": "[Eff 1/2/99]", "auth": "(Auth: HRS §7-1(a))", "imp": "(Imp: HRS §7-2)"},
        "har:1-1-2": {"operative": "The port is open."},
        "har:1-1-3": {"operative": "The port is open.\n", "auth": "7-1(a); 7-2", "imp": "Imp: 7-3"},
        "har:1-1-4": {"operative": "The [old] port."},
        "har:1-1-5": {"operative": "The port.", "auth": "(Auth: HRS §7-1", "imp": "(Imp: HRS §7-2) (a)"},
    }
    spark.createDataFrame([(s, z, b) for s, x in zones.items() for z, b in x.items()], "section_id string, zone string, body string").write.parquet(f"{tmp_path}/zones.parquet")
    assert {r.section_id for r in P.rule_text_round_trip(spark, str(tmp_path)).collect()} == {"har:1-1-4", "har:1-1-5"}
