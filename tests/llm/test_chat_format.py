from postingloom.llm.chat_format import BEGIN, END, perspectives

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part string"


def rendered(frame, **options):
    return {(r.conv_id, r.perspective, r.part): r for r in perspectives(frame, **options).collect()}


def test_every_participant(spark):
    rows = [(1, 0, "system", "Be kind", "x"), (1, 1, "ann", "Hi é", "x"), (1, 2, "bob", "Yo", "x"), (1, 3, "ann", "Bye", "x")]
    found = rendered(spark.createDataFrame(rows[::-1], SCHEMA))
    assert set(found) == {(1, "ann", 0), (1, "bob", 0)}
    ann = found[1, "ann", 0]
    assert ann.rendered == (
        f"{BEGIN}system\nBe kind{END}{BEGIN}assistant\nHi é{END}{BEGIN}user name=bob\nYo{END}{BEGIN}assistant\nBye{END}"
    )
    assert [ann.rendered[s.start : s.end] for s in ann.trained] == [f"Hi é{END}", f"Bye{END}"]
    bob = found[1, "bob", 0]
    assert [bob.rendered[s.start : s.end] for s in bob.trained] == [f"Yo{END}"]


def test_long_dialogues_go_on_in_parts(spark):
    rows = [(k % 2, k, "ann" if k % 3 else "bob", f"m{k}", None) for k in range(1_400)]
    found = rendered(spark.createDataFrame(rows, SCHEMA), part_turns=100)
    assert len(found) == 2 * 2 * 7 and all(r.n_turns == 100 for r in found.values())
    for conv in (0, 1):
        whole = "".join(found[conv, "ann", p].rendered for p in range(7))
        said = [line for line in whole.split(END) if line]
        assert [line.split("\n")[1] for line in said] == [f"m{k}" for k in range(conv, 1_400, 2)]


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, 1, "ann", "x", None), (None, 1, "ann", "x", None), (3, 0, "system", "alone", None),
            (4, 5, "ann", "b", None), (4, 5, "ann", "a", None), (4, 5, "bob", "", None), (5, 0, "ann", "y" * 100_000, None)]
    found = rendered(spark.createDataFrame(rows, SCHEMA))
    assert set(found) == {(None, "ann", 0), (None, "unknown", 0), (4, "ann", 0), (4, "bob", 0), (5, "ann", 0)}
    assert found[None, "ann", 0].rendered == f"{BEGIN}assistant\nx{END}{BEGIN}user name=unknown\n{END}"
    assert found[4, "ann", 0].n_turns == 3 and len(found[4, "ann", 0].trained) == 2
    assert rendered(spark.createDataFrame([], SCHEMA)) == {}
