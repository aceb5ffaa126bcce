import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import chat
from lodestar.llm.queries import QUERIES
from tests.llm.helpers import SF

PIECES = st.lists(st.sampled_from(["<", "|", "\\", "s>", "/", "[", "INST]", "a", "é😀", "<|end|>\n", "<|text|>", "<|turn|>", "</s>", "[/INST]", "<<SYS>>", "\n"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(PIECES, PIECES)
def test_escaping_reads_back(role, text):
    role, text = "".join(role), "".join(text)
    out, a, b = chat.render(role, text)
    assert chat.parse(out) == (role, text)
    inside = chat.escape(text)
    assert not any(s in inside for s in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<SYS>"))
    out, a, b = chat.render("assistant", text)
    assert chat.unescape(out[a:b]) == text


def want(rows):
    conv = {}
    for c, _, r, t in sorted(rows, key=lambda x: (x[0], x[1] if x[1] is not None else -1)):
        conv.setdefault(c, []).append((r or "", t or ""))
    out = {}
    for c, turns in conv.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = QUERIES["op5_chat_format"](spark, SF).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == want(rows)
    sizes = {c: sum(len(x[3] or "") for x in rows if x[0] == c) for c, *_ in rows}
    assert all(r["formatted_chars"] > sizes[r["conv_id"]] for r in got) and len(got) == len(sizes)


def test_rows_with_nulls_repeats_and_long_texts(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 2, "assistant", "y" * 100_000 + "<|end|>\n"), (2, None, "assistant", ""),
            (3, 0, "user", "q" * 3000), (3, 0, "user", "q" * 3000), (3, 1, "assistant", "same" * 700), (3, 1, "assistant", "same" * 700)]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, message string, seq int").repartition(3)
    got = chat.digest(chat.format_conversations(chat.events_of_rows(df))).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == want(rows)
    none = df.where("conv_id is null")
    assert chat.digest(chat.format_conversations(chat.events_of_rows(none))).count() == 0


def test_folding_deltas_edits_and_regenerations(spark):
    log = [(7, 0, 0, "message", "user", "hel"), (7, 0, 1, "delta", None, "lo"), (7, 1, 2, "message", "assistant", "bad"), (7, 1, 3, "delta", None, " answer"),
           (7, 1, 4, "regenerate", None, None), (7, 1, 5, "delta", None, "good "), (7, 1, 6, "delta", None, "answer"), (7, 0, 7, "edit", None, "hello there"),
           (7, 0, 8, "delta", None, "!"), (None, 0, 0, "delta", "user", "orphan"), (8, 0, None, "message", "system", "s"), (8, 0, 1, "delta", None, None)]
    df = spark.createDataFrame(log, "conv_id long, message int, seq long, kind string, role string, text string").repartition(4)
    got = [(r["conv_id"], r["place"], *chat.parse(r["formatted"])) for r in chat.format_conversations(df).collect()]
    assert sorted(got, key=str) == sorted([(7, 0, "user", "hello there!"), (7, 1, "assistant", "good answer"), (None, 0, "user", "orphan"), (8, 0, "system", "s")], key=str)


def test_one_conversation_with_most_rows(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(4000)] + [(2, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = chat.digest(chat.format_conversations(chat.events_of_rows(df))).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == want(rows)


def test_a_very_long_turn_takes_time_in_proportion(spark):
    import time
    text = "ab😀</s>" * 2_300_000                      # 16 million code points
    t = time.time()
    rows = spark.createDataFrame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string")
    got = chat.digest(chat.format_conversations(chat.events_of_rows(rows))).first()
    assert got["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got["loss_chars"] == len(text)
    assert time.time() - t < 100


def test_deltas_are_cut_by_code_points(spark):
    texts = ["", "a", "a" * 1024, "a" * 1025, "😀" * 1500, "\n\r\n " * 700, None]
    rows = spark.createDataFrame([(i, 0, "user", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    got = {}
    for r in chat.events_of_rows(rows).orderBy("conv_id", "seq").collect():
        got.setdefault(r["conv_id"], []).append((r["kind"], r["text"]))
    for i, t in enumerate(texts):
        t = t or ""
        assert got[i] == [("message", "")] + [("delta", t[k:k + 1024]) for k in range(0, len(t), 1024)]
