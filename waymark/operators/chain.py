"""Generation where each prompt needs the answer before it.

Live, an episode is a key with state: the memory that its last frame handed on, the attempt
it is at, and the frames that wait for their turn.  A frame's prompt, facts and ground truth
are made in columns beforehand, so a task only puts the memory into its place, calls the
responder and looks at the answer.  Recorded answers need no state: ``replay`` is joins and
windows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

from waymark.functions import answer_rules as rules
from waymark.functions import fixed_texts as T
from waymark.functions.actions import action_mentions, memory_anchor
from waymark.functions.prompts import has_objects, prompt_halves, render_trace, template_halves
from waymark.functions.validation import needed_boxes, needed_labels
from waymark.operators.traces import (
    FRAME,
    TASK,
    choose_outcome,
    memory_chain,
    template_chain,
    validate_responses,
    with_prompt,
)
from waymark.sources.scratch import materialize

#: (prompt, earlier bad answers and requests to correct them, attempt, frame) -> (status, content)
Responder = Callable[[str, list[tuple[str, str]], int, dict], tuple[str, str]]
POLICIES = ("skip", "template")
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
CARD = "src_idx int, task_idx long, turn int, card string"
NAMES = [*FRAME, "outcome", "memory", "history_source_frame", "anchor", "trace"]
WALKED = (
    "src_idx int, task_idx long, frame_pos int, outcome string, memory string, "
    f"history_source_frame int, anchor string, trace struct<{', '.join(f'{s}: string' for s in T.STEPS)}>"
)


def _with_answer(rows: DataFrame) -> DataFrame:
    answer = render_trace([F.col("trace")[s] for s in T.STEPS], F.col("action"))
    return rows.withColumn("answer", F.when(F.col("trace").isNotNull(), answer))


def replay(eligible: DataFrame, responses: DataFrame, policy: str = "skip", max_retries: int = 3) -> DataFrame:
    """Outcomes, memories, prompts and answers of all eligible frames from recorded answers."""
    if policy not in POLICIES:
        raise ValueError("policy is skip or template")
    outcomes = choose_outcome(validate_responses(eligible, responses), max_retries)
    chained = (memory_chain if policy == "skip" else template_chain)(eligible, outcomes)
    return _with_answer(with_prompt(chained))


def frame_cards(numbered: DataFrame, policy: str = "template") -> DataFrame:
    """src_idx, task_idx, turn, card: all that a frame's turn needs, as one JSON text.

    ``numbered``: eligible frames with ``turn``, their number in the episode from 1.  Only cards for
    ``template`` hold the steps from ground truth, which cost as much as the prompt.
    """
    about = [F.col(c) for c in ("subtask", "objects", "instruction", "subtasks", "completed", "action")]
    prompt, (truth, others) = prompt_halves(*about), template_halves(*about)
    bare = memory_anchor(F.col("subtask"), F.col("objects"), F.col("action"), F.lit(None).cast("string"))
    steps = [truth[0].alias("truth_before"), truth[1].alias("truth_after"), F.array(*others).alias("truth")]
    facts = F.struct(
        has_objects(F.col("objects")).alias("some"),
        needed_labels(F.col("objects")).alias("labels"),
        needed_boxes(F.col("objects")).alias("boxes"),
        action_mentions(F.col("action")).alias("mentions"),
        *(steps if policy == "template" else []),
    )
    card = F.struct(
        F.array(*prompt).alias("prompt"),
        facts.alias("facts"),
        bare.alias("bare"),
        F.struct(*[c for c in numbered.columns if c != "turn"]).alias("frame"),
    )
    text = F.to_json(card, {"ignoreNullFields": "false"})
    return numbered.select(F.col("src_idx").cast("int"), F.col("task_idx").cast("long"), F.col("turn").cast("int"), text.alias("card"))


class EpisodeWalk(StatefulProcessor):
    """Walks an episode frame by frame; frames may arrive in any order and at any time.

    State: ``walk`` (next turn, memory and the frame it is from), ``waiting`` (cards of frames
    whose turn has not come, by turn) and ``trying`` (attempts, whether some answer was bad,
    and the corrections so far, of the frame that waits for its next attempt).  With
    ``waits`` an attempt that fails sets a timer - 1 s after a bad answer, 2 ** attempt s
    after a transport error - and the task goes on with other episodes; without, the next
    attempt follows at once.
    """

    def __init__(self, responder: Responder, policy: str = "skip", max_retries: int = 3, waits: bool = False):
        if policy not in POLICIES:
            raise ValueError("policy is skip or template")
        self.responder, self.policy, self.max_retries, self.waits = responder, policy, max_retries, waits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.walk = handle.getValueState("walk", "turn int, anchor string, frame int")
        self.waiting = handle.getMapState("waiting", "turn int", "card string")
        self.trying = handle.getValueState("trying", "attempts int, bad boolean, notes string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        walk = self.walk.get() if self.walk.exists() else (1, None, None)
        blocked = self.waits and self.trying.exists()
        # asking the store costs a call, so it is asked once and not after every frame
        self.kept = self.waiting.exists()
        for batch in rows:
            done: list[tuple] = []
            for turn, card in zip(batch["turn"].tolist(), batch["card"]):
                if turn != walk[0] or blocked:
                    if turn >= walk[0]:
                        self._keep(turn, card)
                    continue
                walk, blocked = self._turn(walk, card, timerValues, done)
                if not blocked and self.kept:
                    walk, blocked = self._waiting_turns(walk, timerValues, done)
            yield _rows(key, done)
        self.walk.update(tuple(walk))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        done: list[tuple] = []
        walk, _ = self._waiting_turns(self.walk.get(), timerValues, done)
        self.walk.update(tuple(walk))
        yield _rows(key, done)

    def close(self) -> None:
        pass

    def _keep(self, turn: int, card: str) -> None:
        self.waiting.updateValue((turn,), (card,))
        self.kept = True

    def _waiting_turns(self, walk: tuple, timers, done: list) -> tuple[tuple, bool]:
        blocked = False
        while not blocked and self.waiting.exists() and self.waiting.containsKey((walk[0],)):
            card, at = self.waiting.getValue((walk[0],))[0], walk[0]
            walk, blocked = self._turn(walk, card, timers, done)
            if not blocked:
                self.waiting.removeKey((at,))
        self.kept = self.waiting.exists()
        return walk, blocked

    def _turn(self, walk: tuple, text: str, timers, done: list) -> tuple[tuple, bool]:
        """One frame's attempts: (where the walk stands, whether it waits for a timer)."""
        turn, memory, source = walk
        card = json.loads(text)
        frame, facts = card["frame"], card["facts"]
        prompt = card["prompt"][0] + rules.shown_memory(memory) + card["prompt"][1]
        attempts, bad, notes = 0, False, []
        if self.waits and self.trying.exists():
            attempts, bad, told = self.trying.get()
            notes = [tuple(n) for n in json.loads(told)]
        steps = None
        while steps is None and attempts < self.max_retries:
            attempts += 1
            status, content = self.responder(prompt, notes, attempts, frame)
            reason, steps = rules.judge(content, facts) if status == "ok" else ("transport", None)
            if reason not in (None, "transport"):
                bad = True
                notes = [*notes, rules.correction(content, reason, frame["action"], rules.cause(content, reason))]
            if steps is None and self.waits and attempts < self.max_retries:
                self._keep(turn, text)
                self.trying.update((attempts, bad, json.dumps(notes)))
                pause = 1000 if reason != "transport" else 1000 * 2**attempts
                self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + pause)
                return walk, True
        if self.waits:
            self.trying.clear()
        outcome = "trace" if steps else "invalid" if bad else "failed"
        if outcome == "invalid" and self.policy == "template":
            steps = rules.truth_steps(memory, facts)
            outcome = "template" if steps else outcome
        anchor = rules.shown_memory(steps[T.STEPS[3]]) if steps else card["bare"]
        done.append((frame["frame_pos"], outcome, memory, source, anchor, steps))
        return (turn + 1, anchor, frame["frame"]), False


def _rows(key: tuple, done: list[tuple]) -> pd.DataFrame:
    columns = [[k] * len(done) for k in key] + [list(c) for c in zip(*done)] if done else [[] for _ in NAMES]
    made = dict(zip(NAMES, columns))
    made["history_source_frame"] = pd.array(made["history_source_frame"], "Int32")
    return pd.DataFrame(made, columns=NAMES)


def _state_ready(spark: SparkSession) -> None:
    """State lives in RocksDB, which spills to disk; batch jobs need the store's coordinator,
    which the session's streams bring up."""
    spark.conf.set(STORE_CONF, STORE)
    _ = spark.streams.active


def walk_episodes(
    cards: DataFrame, responder: Responder, policy: str = "skip", max_retries: int = 3, waits: bool = False
) -> DataFrame:
    """The walk over ``frame_cards``, a batch or a stream of them; ``waits`` needs a stream.

    A stream's state outlives its micro-batches and restarts, so an episode goes on where it
    stood.  One row a frame, when its turn is over.
    """
    _state_ready(cards.sparkSession)
    return cards.groupBy(*TASK).transformWithStateInPandas(
        EpisodeWalk(responder, policy, max_retries, waits), WALKED, "Append", "ProcessingTime" if waits else "None"
    )


def generate_chain(
    eligible: DataFrame, responder: Responder, policy: str = "skip", max_retries: int = 3
) -> DataFrame:
    """Answers, memories and prompts of all eligible frames.

    ``skip`` writes nothing for a frame without a valid answer; ``template`` answers from
    ground truth if an answer came but none was valid.  Either way the frame hands on a
    memory.  A bad answer and the request to correct it go to the next attempt.

    One job, whatever the length of the longest episode: a shuffle by episode, a walk with
    state, and what it returns - a row a frame, written once so that no answer is asked for
    twice - joined to the frames.  Frames that come before their turn wait in the state
    store, on disk, so no episode is held in memory; the turns of one episode follow each
    other by nature.
    """
    turn = F.row_number().over(Window.partitionBy(*TASK).orderBy("frame_pos"))
    cards = frame_cards(eligible.withColumn("turn", turn), policy)
    walked = materialize(walk_episodes(cards, responder, policy, max_retries), "walked")
    return _with_answer(with_prompt(eligible.join(walked, FRAME)))
