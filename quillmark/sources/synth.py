"""Generated chat logs: clean ones, and ones with a defect for each rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.operators.contract import FIELDS
from quillmark.plans.registry import ANSWER, QUERY

#: Clean pairs of question and answer.
CLEAN = (
    ("주문을 취소하려면 어떻게 하나요", "주문 목록에서 취소 단추를 누르시면 됩니다."),
    ("영업시간이 궁금해요", "평일 아침 아홉 시부터 저녁 여섯 시까지 엽니다."),
    ("회원 탈퇴 방법은 무엇인가요", "내 정보 화면 아래쪽에서 탈퇴를 고르시면 됩니다."),
    ("Where can I find my invoice?", "Your invoice is listed under billing in your account."),
    ("Which sizes do you carry?", "The jacket comes in small, medium and large."),
    ("Is the shop open on Sunday?", "No, the shop opens again on Monday morning."),
)
_KO, _EN = CLEAN[0][0], CLEAN[3][0]
#: Rule, question and answer; None keeps the clean one.
DEFECTS = (
    ("error_keyword", _EN, "The request failed while we looked it up."),
    ("answer_truncated", None, None),
    ("language_mixing", _KO, "주문은 my page 화면에서 취소하세요."),
    ("format_broken", None, "| 10 | 20 |\n| 30 |"),
    ("sensitive_info", _EN, "Write to jane@shop.example for a copy of it."),
    ("language_mismatch", _KO, "Your invoice is listed under billing in your account."),
    ("invalid_link", _EN, "The steps are in the [guide](htp://shop) we sent."),
    ("model_thinking_stopped", None, ""),
    ("placeholder_leak", _KO, "{{고객}}님, 주문이 취소되었습니다."),
)
DEFECT_EVERY = 3
BLANK_EVERY = 97


def generate(spark: SparkSession, n: int = 1000, seed: int = 0, mode: str = "normal") -> DataFrame:
    """``n`` rows with all declared columns as strings. The same seed gives the same rows."""
    if mode not in ("normal", "adversarial"):
        raise ValueError(f"unknown mode {mode}")
    pick = lambda salt, m: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(m)).cast("int")
    pair = lambda k: F.element_at(F.array(*[F.lit(p[k]) for p in CLEAN]), pick("pair", len(CLEAN)) + 1)
    rows = spark.range(n).withColumns({"q": pair(0), "a": pair(1), "n": pick("n", 999) + 1})
    if mode == "adversarial":
        which = F.when(F.col("id") % DEFECT_EVERY == 0, F.pmod(F.floor(F.col("id") / DEFECT_EVERY), F.lit(len(DEFECTS))))
        q, a = F.col("q"), F.col("a")
        for i, (name, question, answer) in enumerate(DEFECTS):
            cut = F.concat(F.substring("a", 1, 18), F.lit("..."))
            q = F.when(which == i, F.lit(question)).otherwise(q) if question is not None else q
            a = F.when(which == i, cut if name == "answer_truncated" else F.lit(answer)).otherwise(a) if name == "answer_truncated" or answer is not None else a
        rows = rows.withColumns({"q": F.when(F.col("id") % BLANK_EVERY == 0, "").otherwise(q), "a": a})
    scored = pick("scored", 10) == 0
    micros = F.pmod(F.xxhash64("id", F.lit(seed), F.lit("time")), F.lit(5 * 86400 * 1_000_000))
    start = F.timestamp_micros(F.unix_micros(F.lit("2025-03-03 08:00:00").cast("timestamp")) + micros)
    end = F.timestamp_micros(F.unix_micros(start) + 500_000 + pick("wait", 29_500_000))
    number = lambda form, m=None: F.format_string(form, F.col("n") % m if m else F.col("n"))
    yes = lambda m: F.when(F.col("n") % m != 0, "true").otherwise("false")
    made: dict[str, Column] = {
        QUERY: F.col("q"),
        ANSWER: F.col("a"),
        "log_table": F.lit("turns"),
        "db_route_result": F.lit("routed"),
        "assist_name": F.lit("helper-1"),
        "model_name": F.lit("model-1"),
        "prompt_template_name": F.lit("template-1"),
        "user_type": F.lit("internal"),
        "db_position_name": number("post-%d", 7),
        "db_id": number("db-%05d"),
        "user_name": number("user-%05d"),
        "user_id": number("u%05d"),
        "job_grade": number("grade-%d", 9),
        "job": number("job-%d", 11),
        "chat_id": number("chat-%06d"),
        "input_msg_id": number("msg-%08d"),
        "turn_start_week": F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), start), F.weekofyear(start)),
        "turn_start_weekday": F.date_format(start, "EEE"),
        "turn_start_date": F.date_format(start, "yyyy-MM-dd HH:mm:ss"),
        "input_msg_start_time": F.date_format(start, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "output_msg_end_time": F.date_format(end, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "rag_yn": yes(2),
        "rag_decide_yn": yes(3),
        "feedback_type": F.when(scored, "thumbs").otherwise(""),
        "feedback_score": F.when(scored, pick("score", 6).cast("string")).otherwise(""),
    }
    for c in ("db_dept_name", "dept_name"):
        made[c] = number("dept-%03d")
    for c in ("dept_div_name", "div_name"):
        made[c] = number("div-%d", 5)
    for c in ("input_msg_type", "input_msg_sub_type", "output_msg_type", "output_msg_sub_type"):
        made[c] = F.lit("text")
    for c in ("feedback_category", "feedback_content", "feedback_detail_content"):
        made[c] = F.lit("")
    return rows.select(*[made[f.name].alias(f.name) for f in FIELDS])
