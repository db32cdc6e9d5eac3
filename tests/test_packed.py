from orefind.operators.packed import explode_packed

CASES = {
    'Field "Notes",Support': ['Field "Notes"', "Support"], '["Q4 | mid-year", "Field \\"Notes\\""]': ["Q4 | mid-year", 'Field "Notes"'], '"A; b";"Field ""Notes"""': ["A; b", 'Field "Notes"'],
    "Kitchen\\; Canteen,Press; Archive;": ["Kitchen; Canteen", "Press", "Archive"], "O'Hanrow Papers, 'x, y'": ["O'Hanrow Papers", "x, y"], ";": [], "  ": [], "": [], None: [],
    '"Support" · ·R': ["Support", "R"], "Sport，Health": ["Sport", "Health"], '"unclosed, x': ['"unclosed', "x"], "a,a": ["a", "a"], "one": ["one"], "a\tb\nc": ["a", "b", "c"], "[not json, x]": ["[not json", "x]"], "x" * 50_000 + ",y": ["x" * 50_000, "y"],
}


def test_values_in_order(spark):
    rows = [(i, text, None, "clash") for i, text in enumerate(CASES)]
    df = spark.createDataFrame(rows, "no int, v string, w string, item string")
    got: dict[int, list] = {}
    for r in explode_packed(df, ["no"], {"v": "", "w": ""}).orderBy("no", "item_pos").collect():
        got.setdefault(r["no"], []).append((r["item_pos"], r["item"]))
        assert r["field_name"] == "v"
    for i, text in enumerate(CASES):
        assert got.get(i, []) == list(enumerate(CASES[text], 1)), text


def test_more_delimiters_and_empty_table(spark):
    df = spark.createDataFrame([(1, "csv/.cfm  *.x"), (1, "csv/.cfm  *.x")], "no int, v string")
    assert sorted(r["item"] for r in explode_packed(df, ["no"], {"v": "/ "}).collect()) == ["*.x", "*.x", ".cfm", ".cfm", "csv", "csv"]
    assert explode_packed(df.limit(0), ["no"], {"v": ""}).count() == 0
