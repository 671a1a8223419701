"""The continuous learning loop over labelled and unseen pools: one turn, or turns until nothing is added."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pactum.operators.features import check_schema
from pactum.operators.learn import predict, split_once, train_candidate
from pactum.operators.pools import merge_pools
from pactum.operators.promotion import (champion, champion_model, enabled_families, evaluate_candidates, log_step, promote,
                                        promote_once, promote_only_if_better, promoted_by, promotion_gate, retrain_decision,
                                        score_candidates, select_champion, stored_candidates)
from pactum.operators.risk import band, collect_feedback
from pactum.plans.session import materialize
from pactum.policy import Policy
from pactum.sources.models import CHAMPION, has_model, load_model, save_model


@dataclass(frozen=True)
class Cycle:
    """What a turn produced. `scores` and `feedback` are None without a champion."""

    retrained: bool
    decision: DataFrame | None
    champion: str | None
    scores: DataFrame | None
    feedback: DataFrame | None


def run_cycle(
    train: DataFrame,
    feedback: DataFrame,
    test: DataFrame,
    unseen: DataFrame,
    features: Sequence[str],
    root: str,
    key: str | Sequence[str] = "id",
    file: str = "file",
    policy: Policy = Policy(),
    always_retrain: bool = True,
    run_id: str | None = None,
) -> Cycle:
    """Merge, train, promote, score, collect.

    `train`, `feedback` and `test` hold key, file, features and label; `unseen` the
    same without label. A turn retrains every time unless `always_retrain` is off,
    when feedback size and the lack of a champion decide. The champion is kept when
    promotion is blocked. New feedback lists the files with a HIGH row that the feedback pool
    lacks, whether or not they also train; their rows join the pool once they are labelled.
    `key` is one column or several.

    With `run_id` champions are kept by version and every step is logged, each once: a turn that is repeated under its
    id trains again only if it promoted nothing, and adds no promotion and no log row.
    """
    spark = train.sparkSession

    def log(step: int, activity: str, artifact: str, outcome: str) -> None:
        if run_id is not None:
            log_step(spark, root, run_id, step, activity, artifact, outcome)

    keys = [key] if isinstance(key, str) else list(key)
    columns = list(dict.fromkeys([*keys, file, *features]))
    for pool in (train, test):
        check_schema(pool.select(*features, "label"), features)
    current = None if run_id is None else champion(spark, root)
    reigning = has_model(spark, root) if run_id is None else current is not None
    retrain = always_retrain or retrain_decision(feedback, reigning, policy).first()["retrain"]
    decision, promoted = None, None
    earlier = None if run_id is None else promoted_by(spark, root, run_id)
    if earlier is not None:
        retrain, promoted = False, earlier["name"]
    if retrain:
        held_out = materialize(test.select(*columns, "label"), "test")
        split = split_once(merge_pools(train.select(*columns, "label"), feedback.select(*columns, "label"), file),
                           keys, features, policy)
        log(1, "train", ", ".join(enabled_families(policy)), f"{split.count()} rows")
        params = {f.name: f.params for f in policy.families}
        for name in enabled_families(policy):
            save_model(train_candidate(split, name, features, params[name]).model, root, name)
        models = stored_candidates(spark, root, enabled_families(policy))
        if models:
            ranked = select_champion(evaluate_candidates(score_candidates(models, held_out), list(models)))
            decision = promotion_gate(ranked, policy)
            if policy.promote_only_if_better:
                held = {CHAMPION: _champion_model(spark, root, current)} if reigning else {}
                recall = (evaluate_candidates(score_candidates(held, held_out), [CHAMPION]).select("recall")
                          if held else ranked.select("recall").limit(0))
                decision = promote_only_if_better(decision, recall)
            decision = materialize(decision, "decision")
            best = decision.first()
            if best is not None:
                log(2, "evaluate", best["name"], best["decision"])
            if run_id is None:
                promoted = promote(models, decision, root)
            else:
                earlier = promote_once(models, decision, root, run_id)
                promoted = earlier["name"] if earlier else None
    if not (promoted or reigning):
        return Cycle(retrain, decision, promoted, None, None)
    current = current if earlier is None else earlier
    if earlier is not None:
        log(3, "promote", earlier["name"], f"version {earlier['version']}")
    scores = band(predict(_champion_model(spark, root, current), unseen.select(*columns)), policy).select(
        *dict.fromkeys([*keys, file]), "score", "level")
    scores = materialize(scores, "scores")
    new = materialize(collect_feedback(scores, feedback, file).select(F.col(file)), "new-feedback")
    if run_id is not None:
        told = scores.agg(F.count("*").alias("n"), F.count_if(F.col("level") == "HIGH").alias("high")).first()
        log(4, "score", f"{told['n']} rows", f"{told['high']} HIGH")
        log(5, "feedback", "files", f"{new.count()} added")
    return Cycle(retrain, decision, promoted, scores, new)


def _champion_model(spark: SparkSession, root: str, promotion: Row | None) -> PipelineModel:
    return load_model(root) if promotion is None else champion_model(spark, root, promotion)


def run_loop(
    train: DataFrame,
    feedback: DataFrame,
    test: DataFrame,
    unseen: DataFrame,
    features: Sequence[str],
    root: str,
    key: str | Sequence[str] = "id",
    file: str = "file",
    policy: Policy = Policy(),
    run_id: str = "loop",
) -> list[Cycle]:
    """Turns until one adds no file: the rows of the files a turn fed back train in the next.

    `unseen` holds the label too, which no score reads; it is what a file's rows bring when they join the feedback
    pool. Every turn but the last adds a file, so the turns end. Run again under its id and on the same data, the loop
    takes the same turns and promotes and logs nothing new.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = list(dict.fromkeys([*keys, file, *features]))
    arrived = materialize(unseen.select(*columns, "label"), "unseen")
    pool = feedback.select(*columns, "label")
    turns: list[Cycle] = []
    while not turns or not (turns[-1].feedback is None or turns[-1].feedback.isEmpty()):
        if turns:
            pool = materialize(pool.unionByName(arrived.join(turns[-1].feedback, file, "left_semi").select(*columns, "label")), "feedback")
        turns.append(run_cycle(train, pool, test, arrived.drop("label"), features, root, key, file, policy, run_id=f"{run_id}.{len(turns) + 1:04d}"))
    return turns
