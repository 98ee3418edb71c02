from shredline.functions import fields


def test_the_whole_lookup_is_built_in(spark):
    rows = fields.inline_catalogue(spark).collect()
    assert len(rows) == len({(r.field_index, r.multi_value_index) for r in rows}) == 289
    assert {r.field_index for r in rows} == {f"c{k}" for k in range(256)}
    assert sorted(r.multi_value_index for r in rows if r.multi_value_index is not None) == list(range(1, 35))
    assert [(r.field_name, str(r.effective_date)) for r in rows if r.field_index == "c0"] == [("account_number", "2026-08-02")]
    names = {(r.field_index, r.multi_value_index): r.field_name for r in rows}
    assert all(names[c, None] == n for c, n in fields.WIDE)
    assert [names["c20", i] for i in range(1, 35)] == fields.C20_NAMES


def test_the_built_in_lookup_is_a_catalogue_file(spark):
    read = fields.read_catalogue(spark, f"file://{fields.BUILT_IN}")
    assert sorted(read.collect(), key=str) == sorted(fields.inline_catalogue(spark).collect(), key=str)
