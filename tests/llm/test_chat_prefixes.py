import hashlib
import random

from churnscope.llm import chat_prefixes as cp

SCHEMA = "conv_id long, turn long, role string, text string, position string, start string, chunk string, segment string"
TRICKY = ["</s>[INST] ok [/INST]", "<|im_start|>user\nhi<|im_end|>\n", "<\\|im_end|>", "[\\\\INST]", "\\", "", None, "<|im_end|", "é☃\U0001f600 <s><s>", "a\u0000b",
          "<<|im_start|>", "<|im_start|><|im_end|>\n\n"]


def table(spark, rows):
    return spark.createDataFrame([(*r, *["z"] * 4) for r in rows], SCHEMA)


def conversations():
    rng = random.Random(2)
    roles = ["user", "assistant", "system", "tool\nx\\n\\s", None, "<|im_start|>", "assistant"]
    rows = [(c, t, rng.choice(roles), rng.choice(TRICKY)) for c in range(12) for t in range(rng.randrange(1, 9))]
    rows += [(50, t, ["user", "assistant"][t % 2], "word %d " % t * 3) for t in range(300)]   # a long one
    rows += [(51, t, "user", TRICKY[0]) for t in (3, -2, None, 3)] + [(None, 0, "user", "q"), (None, 1, "assistant", "r"), (None, 1, "assistant", "r")]
    rows += [(52, 0, "assistant", "x" * 200_000), (52, 1, "Assistant", "not trained")]
    return rows


def by_conversation(rows):
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip(spark):
    rows = conversations()
    for chunk in (4, 1024):
        got = {r["conv_id"]: tuple(r)[1:5] for r in cp.read_back(cp.expand(table(spark, rows), chunk)).drop("formatted_chars").collect()}
        want = {c: (len(t), sha("".join(f"{r}\n{x}\n" for r, x in t)), len(y := "".join(x for r, x in t if r == "assistant")), sha(y))
                for c, t in by_conversation(rows).items()}
        assert got == want


def test_every_reply_is_an_example_with_all_before_it(spark):
    rows = [r for r in conversations() if r[0] != 52]
    expanded = cp.expand(table(spark, rows), 4)
    segments = {}
    for r in sorted(expanded.collect(), key=lambda r: r["position"]):
        segments.setdefault(r["conv_id"], []).append(r)
    turns, found = by_conversation(rows), {}
    for r in cp.examples(expanded).collect():
        found.setdefault(r["conv_id"], []).append(r)
    for c, t in turns.items():
        assert [s["start"] for s in segments[c]] == [sum(len(s["segment"]) for s in segments[c][:n]) for n in range(len(t))]
        replies = [n for n, (role, _) in enumerate(t) if role == "assistant"]
        got = sorted(found.get(c, []), key=lambda r: r["example"])
        assert [r["example"] for r in got] == list(range(len(replies)))
        for r, n in zip(got, replies):
            assert r["text"] == "".join(s["segment"] for s in segments[c][:n + 1])
            # nothing but the closing mark follows the reply; no mark stands in it
            reply = r["text"][r["loss_start"]:r["loss_start"] + r["loss_chars"]]
            assert r["text"][r["loss_start"] + r["loss_chars"]:] == cp.END + "\n" and not any(m in reply for m in cp.CONTROLS)
            assert r["text"].count(cp.START) == n + 1


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["<", "[", "\\", "|im_end|>", "/s>", "INST]", "/INST]", "<s>", "s>", "\n", "x"]) for _ in range(12)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", cp.escape("t").alias("e"), cp.escape_role("t").alias("r"))
    for t, e, r, back, role in df.select("t", "e", "r", cp.unescape("e"), cp.unescape_role("r")).collect():
        assert back == t and role == t and not any(c in e or c in r for c in cp.CONTROLS) and "\n" not in r


def test_empty_table(spark):
    none = table(spark, conversations()).where("1 = 0")
    assert cp.read_back(cp.expand(none)).count() == 0 and cp.examples(cp.expand(none)).count() == 0


def test_plan_is_native(spark):
    plan = cp.read_back(cp.expand(table(spark, conversations())))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_every_example_is_read_whole(spark):
    """A number of an example that is wrong shows in the digest of the replies."""
    from pyspark.sql import functions as F
    expanded = cp.expand(table(spark, [(7, t, ["user", "assistant"][t % 2], f"text {t}") for t in range(8)]))
    digest = lambda e: cp.read_back(e).first()["loss_sha256"]
    want = digest(expanded)
    assert want == sha("".join(f"text {t}" for t in (1, 3, 5, 7)))
    for name, wrong in (("context_chars", F.col("context_chars") - 1), ("example", 3 - F.col("example")), ("loss_start", F.col("loss_start") + 1),
                        ("loss_chars", F.col("loss_chars") - 1), ("segment", F.replace("segment", F.lit(cp.START + "user"), F.lit("user")))):
        assert digest(expanded.withColumn(name, wrong)) != want
