"""JSON flatten and event projection on hand-made messages (FIXTURES.md §4)."""
import json

from abflow import schema as S
from abflow.operators.flatten import flatten_json, project_event


def _flat(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    return [r.fields for r in sorted(flatten_json(df, **kw).collect(), key=lambda r: r.i)]


def test_cases(spark):
    cases = [
        '{"a":1,"o":{"b":"x","c":{"d":true}}}',           # nested objects, unprefixed
        '{"lst":[{"id":"p"},{"id":"q"}]}',                  # array of objects: last index wins
        '{"ids":[1,2],"mix":[{"a":1},2]}',                  # scalars / mixed -> JSON text
        '{"e":[],"o":{},"n":null}',                         # empty array/object add nothing; null absent
        '{"name":"{\\"x\\":1}"}',                           # text that looks like JSON stays text
        '{bad',                                             # bad JSON -> reject
        '[{"a":1}]',                                        # root not an object -> reject
        '{"k":"top","o":{"k":"deep"}}',                     # same key on two levels: shallowest wins
        '{"curr_time":"2019040500"}',
    ]
    got = _flat(spark, cases)
    assert got[0] == {"a": "1", "b": "x", "d": "true"}
    assert got[1] == {"id": "q"}
    assert got[2] == {"ids": "[1,2]", "mix": '[{"a":1},2]'}
    assert got[3] == {}
    assert got[4] == {"name": '{"x":1}'}
    assert got[5] is None and got[6] is None
    assert got[7] == {"k": "top"}
    assert got[8] == {"curr_time": "2019040500"}


def test_depth_cap_and_same_key(spark):
    deep = json.dumps({"l1": {"l2": {"l3": {"x": 1}}}})
    assert _flat(spark, [deep], depth=2) == [{"l2": '{"l3":{"x":1}}'}]
    assert _flat(spark, [deep], depth=3) == [{"l3": '{"x":1}'}]
    assert _flat(spark, [deep]) == [{"x": "1"}]          # without a cap nothing stays nested
    same = '{"a":{"a":{"x":1},"y":2}}'
    assert _flat(spark, [same]) == [{"x": "1", "y": "2"}]
    assert _flat(spark, [same], unwrap_same_key=True) == [{"x": "1"}]


def test_tie_break_path(spark):
    # same key, same depth, same index: smallest path wins ("a.k" < "b.k")
    assert _flat(spark, ['{"b":{"k":"2"},"a":{"k":"1"}}']) == [{"k": "1"}]


def test_project_defaults(spark):
    df = spark.createDataFrame([('{"eventId":"7","curr_time":"2019040500","zzz":"drop"}',)], "value string")
    r = project_event(flatten_json(df)).collect()[0].asDict()
    assert list(r) == S.EVENT_FIELDS and len(r) == 45
    assert r["eventId"] == "7" and r["curr_time"] == "2019040500" and r["mac"] == ""
    df2 = spark.createDataFrame([('{"eventId":"8"}',)], "value string")
    hour = project_event(flatten_json(df2)).collect()[0].curr_time
    assert len(hour) == 10 and hour.isdigit()  # arrival hour


def test_duplicate_keys_never_fail_the_job(spark):
    got = _flat(spark, ['{"a":1,"a":2}', '{"o":{"k":1,"k":2}}', '{"b":3}'])
    assert got[0] == {"a": "2"}      # a repeated key: its last value, on every level
    assert got[1] == {"k": "2"}
    assert got[2] == {"b": "3"}


def test_all_levels(spark):
    """1 to 24 levels, wide messages with many braces, a key at the bottom."""
    def nest(n):
        m = {"mac": f"m{n}"}
        for i in range(n - 1, 0, -1):
            m = {f"o{i}": m, f"s{i}": i}
        return json.dumps(m)
    got = _flat(spark, [nest(n) for n in range(1, 25)] + [json.dumps({"l": [{"k": i} for i in range(40)]}), "{bad", "{'q':'}}','b':{'c':{'d':1}}}"])
    assert [g["mac"] for g in got[:24]] == [f"m{n}" for n in range(1, 25)]
    assert got[23]["s23"] == "23" and got[24] == {"k": "39"} and got[25] is None and got[26] == {"q": "}}", "d": "1"}


def test_numbers_as_spark_spells_them(spark):
    """A known loss: JSON numbers come out in canonical form, beyond 38 digits as a double."""
    assert _flat(spark, ['{"a":1.50,"b":1e5,"c":123456789012345678901234567890123456789012,"d":"1.50"}']) == [
        {"a": "1.5", "b": "100000.0", "c": "1.2345678901234568E41", "d": "1.50"}]


def test_depth_counts_braces_outside_strings(spark):
    from abflow.operators.flatten import nesting
    cases = {'{"a":1}': 1, '{"a":{"b":{"c":1}}}': 3, '{"a":"{{{{{{{{ \\" { \\\\"}': 1, "{'a':'}{ \\' {','b':{\"it's {\":1}}": 2, '[{"a":1}]': None, "{bad": None,
             '{"x":[{"y":1},{"z":{"q":"}"}}],"w":{}}': 3, '{"a":1,"a":{"b":2}}': 2, "{}": 1, "": None, None: None}
    got = spark.createDataFrame([(t,) for t in cases], "value string").select("value", nesting("value").alias("n")).collect()
    assert {r.value: r.n for r in got} == cases


def test_no_checkpoint_up_to_six_levels(spark, tmp_path):
    """Many braces, few levels: no cut; one deep message among them is cut alone."""
    from abflow.session import ensure_checkpoint_dir
    import os
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    count = lambda: sum(len(d) for _, d, _ in os.walk(top))
    wide = json.dumps({"l": [{"k": {"m": i}} for i in range(40)], "s": "{" * 30})
    before = count()
    assert _flat(spark, [wide, wide])[0] == {"m": "39", "s": "{" * 30}
    assert count() == before
    deep = '{"o":' * 8 + '{"mac":"x"}' + "}" * 8
    assert _flat(spark, [wide, deep]) == [{"m": "39", "s": "{" * 30}, {"mac": "x"}]
    assert count() > before


def test_bound_of_levels_counts_braces_only(spark):
    """Messages of six braces or fewer are not searched for strings; the bound is never under the levels."""
    from abflow.operators.flatten import STEP, level_bound, nesting
    texts = ['{"a":1}', '{"a":{"b":{"c":1}}}', '{"a":"{{{"}', "{" * 3, "[1]", "", None, '{"a":"' + "{" * 30 + '"}', '{"o":' * 8 + "1" + "}" * 8, "{" * 30]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r.value: (r.b, r.n) for r in df.select("value", level_bound("value").alias("b"), nesting("value").alias("n")).collect()}
    for t, (b, n) in got.items():
        assert (b is None) == (n is None) and (b is None or n <= b)
        assert b is None or b == (t.count("{") if t.count("{") <= STEP else n)
