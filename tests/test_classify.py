import pytest
from pyspark.sql import functions as F

from segmentry import config as C
from segmentry.operators import classify as K

ANSWER = "batch long, answer string"


def parsed(df):
    return {(r.batch, r.ADS_IDX, r.NAME, r.INDUSTRY) for r in df.collect()}


TEXT = (
    "\n  Sure, here you go\nADS_IDX | NAME | INDUSTRY\n--- | --- | ---\n 1 |  a b | 게임 \n2 | x | y | z\n3 | only two\n"
    "four | d | 게임\n5 | e |\n6 | f | NaN\n7|g|서비스\n| h | 게임\n8 | a---b | 게임\n  "
)


def test_strict_parser(spark):
    got = parsed(K.parse_strict(spark.createDataFrame([(0, TEXT)], ANSWER)))
    assert got == {
        (0, 1, "a b", "게임"), (0, 5, "e", None), (0, 6, "f", None), (0, 7, "g", "서비스"),
    }


def test_lenient_parser(spark):
    got = parsed(K.parse_lenient(spark.createDataFrame([(0, TEXT)], ANSWER)))
    assert got == {
        (0, 1, "a b", "게임"), (0, 2, "x", "y"), (0, 5, "e", None), (0, 6, "f", None), (0, 7, "g", "서비스"),
        (0, 8, "a---b", "게임"),
    }


def test_missing_and_oversized_answers(spark):
    df = spark.createDataFrame([(0, None), (1, ""), (2, "99999999999999999999 | a | b")], ANSWER)
    assert parsed(K.parse_strict(df)) == set() and parsed(K.parse_lenient(df)) == set()


def test_first_answer_follows_file_name_order(spark):
    master = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "ADS_IDX long, NAME string")
    answers = spark.createDataFrame(
        [(2, 0, 1, "two"), (10, 0, 1, "ten"), (1, 5, 2, "late"), (1, 2, 2, "early"), (1, 0, 9, "stray")],
        "batch long, line_no int, ADS_IDX long, INDUSTRY string",
    )
    got = {r.NAME: r.INDUSTRY for r in K.merge_answers(master, answers).collect()}
    assert got == {"a": "ten", "b": "early", "c": None}
    assert [r.NAME for r in K.unanswered(K.merge_answers(master, answers)).collect()] == ["c"]


def mapping(spark, rows):
    return spark.createDataFrame(rows, "NAME string, INDUSTRY string")


def test_finalize_takes_the_last_round_then_filters(spark):
    rounds = [
        mapping(spark, [("a", "게임"), ("b", None), ("c", "기타"), ("d", "쇼핑"), ("e", "가전/제조"), ("f", "게임")]),
        mapping(spark, [("b", "카페"), ("c", "서비스")]),
        mapping(spark, [("f", None)]),
    ]
    got = {r.NAME: r.INDUSTRY for r in K.finalize_mapping(rounds).collect()}
    assert got == {"a": "게임", "b": "F&B/식품", "c": "서비스", "d": "커머스/유통"}


def test_finalize_is_idempotent(spark):
    once = K.finalize_mapping([mapping(spark, [("a", "핀테크"), ("b", "게임")])])
    assert sorted(K.finalize_mapping([once]).collect()) == sorted(once.collect())


def test_every_synonym_leads_to_an_industry():
    assert set(C.INDUSTRY_SYNONYMS.values()) <= set(C.INDUSTRIES)
    assert len(C.INDUSTRY_SYNONYMS) == 20 and len(C.INDUSTRIES) == 8


def test_prompts_list_each_batch_in_id_order(spark):
    names = spark.createDataFrame([(f"n{i:03d}",) for i in range(120)] * 2, "NAME string")
    prompts = K.build_prompts(K.build_batches(names, 50), "<{names_list}>").orderBy("batch").collect()
    assert [p.prompt.count("\n") + 1 for p in prompts] == [50, 50, 20]
    assert prompts[0].prompt.startswith("<1 | n000\n2 | n001\n") and prompts[2].prompt.endswith("120 | n119>")


def test_template_names_every_class():
    template = K.prompt_template()
    assert all(industry in template for industry in [*C.INDUSTRIES, C.OTHER_INDUSTRY])
    assert template.count("{names_list}") == 1
    assert "nothing before" in K.prompt_template(answer_only=True) and "nothing before" not in template


def test_cascade_asks_only_about_unanswered_names(spark):
    def knows(*names):
        def answer(prompt):
            lines = [line for line in prompt.split("\n") if line.count(" | ") == 1]
            return "\n".join(f"{line} | 게임" for line in lines if line.split(" | ")[1] in names)

        return answer

    names = spark.createDataFrame([(n,) for n in "abcdabcd"], "NAME string")
    rounds = K.cascade(names, [knows("a", "z"), knows("a", "b"), knows("c")], size=2, concurrency=2)
    got = [{r.NAME: r.INDUSTRY for r in table.collect()} for table in rounds]
    assert got == [
        {"a": "게임", "b": None, "c": None, "d": None}, {"b": "게임", "c": None, "d": None}, {"c": "게임", "d": None}
    ]
    assert {r.NAME for r in K.finalize_mapping(rounds).collect()} == {"a", "b", "c"}


def test_a_failing_classifier_fails_the_job(spark):
    def broken(prompt):
        raise ValueError("no answer")

    prompts = spark.createDataFrame([(0, "p")], "batch long, prompt string")
    with pytest.raises(Exception, match="no answer"):
        K.classify(prompts, broken, 2)


def test_ledger_asks_each_answered_batch_once(spark, tmp_path):
    """Every prompt fails at its first call; a later run with a changed prompt asks only that one."""
    calls = tmp_path / "calls"
    calls.mkdir()

    def once_broken(prompt):
        mark = calls / prompt
        if not mark.exists():
            mark.write_text("1")
            raise ConnectionError("first call")
        mark.write_text(str(int(mark.read_text()) + 1))
        return prompt.upper()

    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(9)] + [(9, "p0")], "batch long, prompt string")
    ledger = str(tmp_path / "ledger")
    for _ in range(2):
        got = K.classify_with_ledger(prompts, once_broken, ledger, 3, wave=4)
        assert sorted(map(tuple, got.collect())) == [*((i, f"P{i}") for i in range(9)), (9, "P0")]
    assert {p.name: p.read_text() for p in calls.iterdir()} == {f"p{i}": "2" for i in range(9)}
    more = K.classify_with_ledger(prompts.unionByName(spark.createDataFrame([(10, "new")], prompts.schema)), once_broken, ledger, 3)
    assert more.count() == 11 and sorted(p.name for p in calls.iterdir())[0] == "new"
    assert K.ledger_rows(spark, ledger).count() == 2 * 10


def test_ledger_keeps_answers_when_a_call_goes_on_failing(spark, tmp_path):
    def broken(prompt):
        if prompt == "bad":
            raise ValueError("no")
        return prompt

    prompts = spark.createDataFrame([(0, "good"), (1, "bad"), (2, "fine")], "batch long, prompt string")
    with pytest.raises(RuntimeError, match="1 prompts"):
        K.classify_with_ledger(prompts, broken, str(tmp_path / "l"), 2, attempts=2)
    rows = {(r.batch, r.answer, r.error): 0 for r in K.ledger_rows(spark, str(tmp_path / "l")).collect()}
    assert set(rows) == {(0, "good", None), (2, "fine", None), (1, None, "ValueError: no")}
    assert K.classify_with_ledger(prompts, lambda p: p, str(tmp_path / "l"), 2).count() == 3


def test_cascade_with_a_ledger_gives_the_same_rounds(spark, tmp_path):
    def knows(prompt):
        return "\n".join(f"{x} | 게임" for x in prompt.split("\n") if x.count(" | ") == 1 and x.endswith("a"))

    names = spark.createDataFrame([(f"{i}{c}",) for i in range(5) for c in "ab"], "NAME string")
    plain, kept = K.cascade(names, [knows, knows], 3, 2), K.cascade(names, [knows, knows], 3, 2, str(tmp_path / "l"))
    for a, b in zip(plain, kept):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize(
    "name, industry",
    [
        ("[정답입력] 게임용PC 본체", "가전/가구"), ("보드게임카페 홍대", "서비스"), ("자동차 키링 맞추기", "커머스/유통"),
        ("법무법인 하나", "서비스"), ("블록 퍼즐 게임", "게임"), ("신용카드 발급", "금융/보험"), ("모르는 이름", "기타"),
        ("카페 라떼", "F&B/식품"),
    ],
)
def test_keyword_rules(spark, name, industry):
    df = spark.createDataFrame([(name,)], "NAME string")
    assert df.select(K.rule_industry(F.col("NAME")).alias("i")).first().i == industry


def test_waves_broadcast_at_most_a_wave(spark, tmp_path, monkeypatch):
    """No join of the prompts with the ledger is a broadcast, and no wave reads the ledger: both grow with the prompts."""
    ledgers, state = [], K.ledger_state
    monkeypatch.setattr(K, "ledger_state", lambda *a: ledgers.append(1) or state(*a))
    prompts = spark.range(40).selectExpr("id DIV 2 AS batch", "concat('p', id) AS prompt")
    got = K.classify_with_ledger(prompts, lambda p: p.upper(), str(tmp_path / "l"), 2, wave=7)
    assert sorted(map(tuple, got.collect())) == sorted((i // 2, f"P{i}") for i in range(40))
    assert len(ledgers) == 2 and K.ledger_rows(spark, str(tmp_path / "l")).count() == 40
