from revlens.llm import near_dedup as N


def test_one_row_of_each_group_stays(spark, docs_of):
    """Ids with two texts, null ids and repeated rows: rows are decided, not ids."""
    rows = [(5, "a b c d e"), (5, "x y z q r"), (3, "a B c d e"), (None, "a b c d e"), (None, None), (7, "x y z q r"),
            (7, "x y z q r"), (8, ""), (9, "p q"), (11, "k l m n o"), (11, "k l m n o"), (None, "u v w"), (None, "u v w"),
            (12, "f g h"), (12, "F g h")]
    docs = docs_of([(*r, None, f"s{i}", 1) for i, r in enumerate(rows)])
    kept = N.drop_near_copies(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    twelve = [t for d, t in got if d == 12]
    assert len(twelve) == 1
    assert got == sorted([(3, "a B c d e"), (5, "x y z q r"), (8, ""), (9, "p q"), (11, "k l m n o"), (12, twelve[0]),
                          (None, None), (None, "u v w")], key=str)
    assert {r.source for r in kept.collect()} <= {f"s{i}" for i in range(len(rows))}


def test_without_repeated_rows_and_empty(spark, docs_of):
    docs = docs_of([(2, "a b c d e", None, "s", 1), (1, "x y", None, "s", 1), (4, "A b c d e", None, "s", 1)])
    assert sorted(r.doc_id for r in N.drop_near_copies(docs).collect()) == [1, 2]
    assert N.drop_near_copies(docs_of([])).count() == 0
