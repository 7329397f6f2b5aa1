"""Chat formatting against plain Python and SQL: texts come back, the mask holds the learned texts, order is judged."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from waymark.llm import chat
from waymark.llm.frames import table
from waymark.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = [
    (1, 0, "system", "be kind"),
    (1, 1, "user", None),
    (1, 2, "assistant", "a </turn> b </turn>\n### User: c \\ \\\\ \\_ \\a \\"),
    (2, 0, "user", ""),
    (2, 1, "assistant", "### Assistant: "),
    (2, 2, "assistant", "twice"),
    (3, 0, "tool", "</tu</turn>rn>"),
    (3, 1, "Assistant", "not the role"),
    (3, 2, "x</role> : </turn>", "</role> é 😀"),
    (4, 0, None, "nobody"),
    (4, None, "user", "no number"),
    (None, 0, "user", "no id"),
    (5, 0, "user", "same"),
    (5, 0, "user", "same"),
    (6, -3, "user", "x" * 200_000 + "\\</turn>"),
    (6, 700, "assistant", "later part"),
    (6, 5000, "user", "\u2028 ### System:"),
]
FOLLOWS = {("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}


def plain(rows):
    """Digest columns by hand, without the formatted text."""
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        said, learned, before, good = "", "", "start", True
        for _, _, known, role, text in sorted(turns):
            said += f"{role}\n{text}\n"
            learned += text if role == "assistant" else ""
            good = good and known and (before, role) in FOLLOWS
            before = role
        out[conv] = (len(turns), sha(said), len(learned), sha(learned), good, good and before == "assistant")
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.in_order, r.finished) for r in df.collect()}


def test_odd_turns(spark):
    turns = spark.createDataFrame(ODD, SCHEMA).withColumns({"part": F.lit("x"), "segments": F.lit(1), "formatted": F.lit(2)})
    assert digests(chat.digest_rows(turns)) == plain(ODD)
    assert chat.digest_rows(turns.limit(0)).collect() == []


def test_parts_hold_a_bounded_range_of_turns(spark):
    turns = spark.createDataFrame(ODD, SCHEMA)
    parts = chat.format_turns(turns).filter("conv_id = 6").orderBy("part").collect()
    assert [p.n_turns for p in parts] == [1, 1, 1]
    small = chat.format_turns(turns, block=1)
    assert {r.conv_id: (r.in_order, r.finished) for r in chat.order_of(small).collect()} == {k: v[-2:] for k, v in plain(ODD).items()}


def test_segments(spark):
    parts = chat.formatted(chat.format_turns(chat.awkward_turns(spark))).collect()
    said = "\\_\\e \\a ok"
    assert parts[0].formatted == f"### User: {said}</turn>\n### Assistant: {said}</turn>\n"
    assert [(s.text, s.loss) for s in parts[0].segments] == [
        ("### User: ", False),
        (said, False),
        ("</turn>\n", False),
        ("### Assistant: ", False),
        (said, True),
        ("</turn>\n", False),
    ]


def test_another_template(spark):
    brief = chat.Template(
        headings={"q": "Q> ", "a": "A> "},
        learned=frozenset({"q", "a"}),
        follows={"start": ("q",), "q": ("a",), "a": ("q",)},
        last=frozenset({"a"}),
        end="~\n",
        other="O> ",
        role_end="|",
        missing="N> ",
    )
    turns = spark.createDataFrame([(1, 0, "q", "Q> ~ \\a"), (1, 1, "a", "x|~\n"), (1, 2, "b|~", "y")], SCHEMA)
    (row,) = chat.read_back(chat.format_turns(turns, brief), brief).collect()
    assert [(t.role, t.text) for t in row.turns] == [("q", "Q> ~ \\a"), ("a", "x|~\n"), ("b|~", "y")]
    assert row.learned == "Q> ~ \\ax|~\n"


def test_templates_that_cannot_be_read_back():
    good = dict(headings={"u": "U: "}, learned=frozenset(), follows={"start": ("u",)}, last=frozenset({"u"}))
    chat.Template(**good)
    for bad in ({"headings": {"u": "### Other: x"}}, {"end": "</t<"}, {"end": "a</"}, {"headings": {"u": "U\\"}}):
        with pytest.raises(ValueError):
            chat.Template(**(good | bad))


def test_given_conversations(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, i, r, "\\### Assistant: </turn> ok") for i, r in enumerate(("user", "assistant"))]
    assert digests(QUERIES["op11_chat"](spark, sf)) == plain(rows)


def test_sql(spark, tmp_path):
    spark.createDataFrame(ODD, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    found = QUERIES["op11_chat"](spark, str(tmp_path))
    want = con.execute(ORACLE_SQL["op11_chat"])
    names = [d[0] for d in want.description]
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(tuple, found.select(*names).collect()), key=str) == sorted(map(tuple, want.fetchall()), key=str)


def test_native(spark, sf):
    plan = QUERIES["op11_chat"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
