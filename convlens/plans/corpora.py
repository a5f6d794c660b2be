"""Chains from raw corpora to labelled, cleaned, split tables.

Every choice of rows (duplicates, samples, splits) is made on narrow tables of
ids and labels; the wide text rows are joined to the outcome once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convlens import constants as K
from convlens import session
from convlens.functions import columns as B
from convlens.functions import conversation as C
from convlens.functions import text as TX
from convlens.operators import dedup, joins, metrics, models, names, sampling

Stage = Callable[[DataFrame], DataFrame]


def flat_columns(conversation):
    """Flattened and cleaned text of a nested conversation."""
    text = C.text_with_roles(conversation)
    return {"conversation": text, "conversation_proc": TX.clean_text(text)}


def single_turn(train: DataFrame, test: DataFrame, val: float = 0.2, seed: int = K.SEED) -> DataFrame:
    """(conversation_id, conversation, conversation_proc, n_words, harm, split, row_id).

    Inputs have row_id, prompt, response, prompt_harm_label and
    response_harm_label. The first row of each prompt decides its label. Test
    ids start above the training ids.
    """

    def labelled(raw: DataFrame) -> DataFrame:
        known = raw.filter(F.col("prompt").isNotNull())
        first = dedup.first_rows(known, ["prompt"], "row_id", ["prompt_harm_label", "response_harm_label"])
        return first.select("row_id", B.harm_of(F.col("prompt_harm_label"), F.col("response_harm_label")).alias("harm"))

    def built(raw: DataFrame, narrow: DataFrame) -> DataFrame:
        rows = raw.select("row_id", "prompt", "response").join(narrow, "row_id")
        rows = rows.withColumn("c", C.from_prompt(F.col("prompt"), F.col("response")))
        return rows.withColumns({**flat_columns(F.col("c")), "n_words": C.n_words(F.col("c"))}).select(
            "conversation_id", "conversation", "conversation_proc", "n_words", "harm", "split", "row_id"
        )

    for_train = sampling.stratified_split(labelled(train), "harm", "row_id", val, seed=seed)
    for_train = for_train.withColumn("conversation_id", F.col("row_id"))
    offset = sampling.next_free_id(train, "row_id")
    for_test = labelled(test).withColumns({"split": F.lit("test"), "conversation_id": F.col("row_id") + offset})
    return built(train, for_train).unionByName(built(test, for_test))


def moderated(chats: DataFrame, min_turns: int, language: str = "English") -> DataFrame:
    """Chats of one language with enough turns; adds harm and flagged categories."""
    kept = chats.filter((F.col("language") == language) & (F.col("turn") >= min_turns))
    m = F.col("openai_moderation")
    return kept.withColumns({"harm": C.any_flagged(m).cast("int"), "flagged_categories": C.flagged_categories(m)})


def multi_turn(chats: DataFrame, dictionary: DataFrame, sample_size: int = 2000, min_turns: int = 3,
               max_words: int = K.MAX_WORDS, seed: int = K.SEED, stage: Stage = session.stage, complete: bool = True) -> DataFrame:
    """Balanced test table of long chats: (conversation_id, conversation, conversation_proc, n_words, harm, flagged_categories).

    Length is measured after names are replaced. Candidates are found on all
    chats, sampled as staged (id, harm) rows, and only the sample is flattened.
    """
    kept = moderated(chats, min_turns)
    kept = kept.withColumn("conversation", C.normalize(kept, "conversation"))
    named = names.replace_in_conversations(kept, "conversation_id", "conversation", dictionary, F.col("redacted"), seed)
    sized = named.withColumn("n_words", C.n_words(F.col("conversation"))).filter(F.col("n_words") < max_words)
    candidates = stage(sized.select("conversation_id", "harm"))
    chosen = sampling.sample_balanced(candidates, sample_size, "harm", "conversation_id", seed=seed, complete=complete)
    rows = sized.join(chosen.select("conversation_id"), "conversation_id", "left_semi")
    return rows.withColumn("c", F.col("conversation")).withColumns(flat_columns(F.col("c"))).select(
        "conversation_id", "conversation", "conversation_proc", "n_words", "harm", "flagged_categories"
    )


def length_matched(attacks: DataFrame, chats: DataFrame, dictionary: DataFrame, bins: int = K.LENGTH_BINS,
                   seed: int = K.SEED, stage: Stage = session.stage) -> DataFrame:
    """All attack dialogues and as many clean chats of matching length: (conversation_id, conversation as JSON, harm, n_chars)."""
    harmful = attacks.select(F.col("id").alias("conversation_id"), C.normalize(attacks, "history").alias("conversation"))
    clean = moderated(chats, 2).filter("harm = 0")
    benign = names.replace_in_conversations(clean, "conversation_id", "conversation", dictionary, F.col("redacted"), seed)
    length = C.n_chars(F.col("conversation"))
    harmful = harmful.withColumn("n_chars", length)
    benign = benign.select("conversation_id", "conversation", length.alias("n_chars"))
    pool = stage(benign.select("conversation_id", "n_chars"))
    target = stage(harmful.select("conversation_id", "n_chars"))
    matched = sampling.sample_matched(target, pool, "n_chars", "conversation_id", bins, seed)
    rows = benign.join(matched.select("conversation_id"), "conversation_id", "left_semi")
    both = harmful.withColumn("harm", F.lit(True)).unionByName(rows.withColumn("harm", F.lit(False)))
    return both.withColumn("conversation", F.to_json("conversation"))


def _prepared(df: DataFrame, conversation: str) -> DataFrame:
    """Text without roles, tags, punctuation and stop words; blank rows dropped."""
    cleaned = df.withColumn("_c", TX.clean_text(C.text_without_roles(F.col(conversation))))
    kept = cleaned.select("conversation_id", TX.held(TX.without_stop_words(F.col("_c"))).alias("conversation"), "harm")
    return kept.filter(~TX.is_blank(F.col("conversation")))


def two_corpora(multi: DataFrame, single_train: DataFrame, single_test: DataFrame, seed: int = K.SEED,
                stage: Stage = session.stage, complete: bool = True) -> DataFrame:
    """Splits of a multi-turn corpus, and single-turn splits of the same sizes.

    Inputs have conversation_id, conversation (nested) and harm. The single-turn
    samples are balanced by class. Returns (corpus, split, conversation_id, conversation, harm).
    """
    ready = {"multi": _prepared(multi, "conversation"), "train": _prepared(single_train, "conversation"), "test": _prepared(single_test, "conversation")}
    narrow = {name: stage(df.select("conversation_id", "harm")) for name, df in ready.items()}

    splits = stage(sampling.three_way_split(narrow["multi"], "harm", "conversation_id", seed=seed))
    sizes = splits.agg(
        F.count_if(F.col("split") != "test").alias("fit"), F.count_if(F.col("split") == "test").alias("test")
    ).select(F.struct("fit", "test")).scalar()
    fit = sampling.sample_balanced(narrow["train"], sizes["fit"], "harm", "conversation_id", seed=seed, complete=complete)
    fit = sampling.stratified_split(stage(fit), "harm", "conversation_id", 0.25, seed=seed)
    test = sampling.sample_balanced(narrow["test"], sizes["test"], "harm", "conversation_id", seed=seed, complete=complete)

    def wide(name: str, chosen: DataFrame, corpus: str) -> DataFrame:
        rows = ready[name].join(chosen.select("conversation_id", "split"), "conversation_id")
        return rows.select(F.lit(corpus).alias("corpus"), "split", "conversation_id", "conversation", "harm")

    out = wide("multi", splits, "multi").unionByName(wide("train", fit, "single"))
    return out.unionByName(wide("test", test.withColumn("split", F.lit("test")), "single"))


def error_analysis(table: DataFrame, meta: DataFrame, columns: Sequence[str] = ("adversarial", "subcategory"),
                   strength: float = 8.0, min_df: int = 5) -> dict[str, DataFrame]:
    """Fit on the train split, score the rest, attach metadata, and report.

    Returns the scored rows and the tables by split, subgroup and subcategory.
    """
    fitted = models.fit_texts(table, F.col("split") == "train", "conversation_proc", "harm", [(min_df, strength)])
    scored = fitted.scored().filter("split <> 'train'")
    full = joins.attach(scored, meta, "conversation_id", columns)
    full = session.stage(full.withColumns(
        {"correct": B.correct(F.col("pred"), F.col("harm")), "error_type": B.error_type(F.col("harm"), F.col("pred"))}
    ))
    return {
        "scored": full,
        "by_split": metrics.subgroup_metrics(full, "harm", "pred", "prob", "split"),
        "by_group": metrics.group_accuracy(full, ["adversarial", "harm"]),
        "by_subcategory": metrics.subgroup_metrics(full, "harm", "pred", "prob", "subcategory"),
        "misses": metrics.miss_rates(full, "harm", "pred", "subcategory"),
        "false_alarms": metrics.false_alarm_rates(full, "harm", "pred", "subcategory"),
        "calibration": metrics.calibration(full, "harm", "pred", "prob"),
    }
