from tickweave.llm import line_dedup


def cleaned(spark, rows, folder, **settings):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.drop_recurring(frame, folder, **settings).collect()
    return {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in found}


def test_variable_fields_are_generalised(spark, folder):
    names = ["alice", "bob", "carol", "dave"]
    rows = [
        (i, f"Posted by user {name} on day {i} of the week\nown prose about {name} number {i}q here")
        for i, name in enumerate(names, 1)
    ]
    got = cleaned(spark, rows, folder())
    assert got[1] == (2, 0, rows[0][1])  # the first line of the template stays
    for i in (2, 3, 4):
        assert got[i][:2] == (2, 1) and got[i][2].startswith("own prose about")


def test_prose_of_one_leaf_is_left_alone(spark, folder):
    rows = [(i, f"the cat sat {w} {v} {u}") for i, (w, v, u) in enumerate(
        [("on", "a", "mat"), ("by", "some", "tree"), ("in", "the", "sun"), ("at", "my", "door")]
    )]
    assert all(got[1] == 0 for got in cleaned(spark, rows, folder()).values())


def test_short_and_rare_lines_stay(spark, folder):
    rows = [(i, "Two words\n\nseen in two documents only" if i < 3 else "Two words") for i in range(1, 6)]
    assert all(got[1] == 0 for got in cleaned(spark, rows, folder()).values())


def test_repeats_within_a_document_do_not_make_a_template(spark, folder):
    rows = [(1, "\n".join(["the very same line again"] * 5)), (2, "something else entirely here")]
    assert cleaned(spark, rows, folder())[1][1] == 0


def test_odd_documents(odd_documents, no_documents, folder):
    got = line_dedup.drop_recurring(odd_documents, folder("a"))
    assert set(got.columns) == set(odd_documents.columns) | {"n_lines", "n_dropped"}
    rows = got.collect()
    assert len(rows) == odd_documents.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert by_id[1]["text"] is None and by_id[1]["n_lines"] == 0
    assert by_id[2]["text"] == "" and by_id[2]["n_lines"] == 1
    assert by_id[7]["n_dropped"] == 0  # ids 6 (one document) and 7: two documents are too few
    assert line_dedup.drop_recurring(no_documents, folder("b")).count() == 0


SHARED = "a passage that exactly two documents share word for word"


def test_whole_lines_of_two_documents_recur(spark, folder):
    fields = "from 1 to 2 of 3"
    rows = [(1, f"{SHARED}\nown words of the first"), (2, f"other words here\n{SHARED}")]
    rows += [(3, f"{fields}\nthird one"), (4, f"{fields}\nfourth one")]
    got = cleaned(spark, rows, folder(), pairs=True)
    assert got[1] == (2, 0, rows[0][1]) and got[2] == (2, 1, "other words here")
    assert got[3][1] == got[4][1] == 0  # mostly variable fields


def test_copies_of_a_document_stay_copies(spark, folder):
    copy = f"{SHARED}\nown words of the first"
    rows = [(1, copy), (2, copy.upper()), (3, f"other words here\n{SHARED}")]
    got = cleaned(spark, rows, folder("a"), min_docs=4, pairs=True)
    assert [got[i][1] for i in (1, 2, 3)] == [0, 0, 1]
    assert cleaned(spark, rows[:2], folder("b"), pairs=True)[2][1] == 0


def test_pairs_leave_recurring_templates_as_they_are(spark, folder):
    names = ["alice", "alice", "bob", "carol"]
    rows = [(i, f"Posted by user {name} on day {i} of the week\nown {name}{i}") for i, name in enumerate(names, 1)]
    assert [got[1] for _, got in sorted(cleaned(spark, rows, folder(), pairs=True).items())] == [0, 1, 1, 1]
