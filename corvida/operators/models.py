"""The boundary to external models: batches go to a callable, what does not come back gets a default.

The callable takes a list of JSON payloads and gives a list of (id, answer); it runs in the tasks, so it must be
picklable. A batch is retried before its rows fall back; nothing here is called in a compared query.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Call = Callable[[list[str]], list[tuple[str, str]]]
_FENCE = regex.compile(r"```[A-Za-z]*\s*(.*?)```", regex.S)
_OPEN_FENCE = regex.compile(r"```[A-Za-z]*\s*(.*)$", regex.S)
_VOTE = regex.compile(r"(?i)CONSENSUS:\s*(FINAL|CONTINUE)")


class Fallback:
    """Calls the models in a circle: from the one that worked last, on to the next when it fails; when all fail, the
    circle moves on by one and the last error is raised. Each task has its own."""

    def __init__(self, models: list[Call]):
        self.models, self.at = models, 0

    def __call__(self, payloads: list[str]) -> list[tuple[str, str]]:
        error: Exception = ValueError("no model is configured")
        for step in range(len(self.models)):
            n = (self.at + step) % len(self.models)
            try:
                found = self.models[n](payloads)
            except Exception as e:  # noqa: BLE001 - any failure passes the call on
                error = e
                continue
            self.at = n
            return found
        self.at = (self.at + 1) % max(1, len(self.models))
        raise error


def relay(units: DataFrame, call: Call, order: list[str], most_rounds: int, size: int) -> DataFrame:
    """(batch, rounds, state, consensus): batches of `size` units (pos, unit) are passed from model to model.

    A turn's prompt is the batch's units until an answer could be parsed, and the last parsed state from then on. The
    rounds end when all models of a round vote FINAL, or with the last round. A batch is one group of `size` rows.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        state, rounds, agreed = None, 0, False
        units_of = json.dumps(frame.sort_values("pos")["unit"].tolist(), ensure_ascii=False)
        while rounds < most_rounds and not agreed:
            rounds += 1
            votes = []
            for model in order:
                try:
                    answer = dict(call([json.dumps({"model": model, "state": state, "units": None if state else units_of}, ensure_ascii=False)])).get(model, "")
                except Exception:  # noqa: BLE001 - a failed turn leaves the state and votes for another round
                    answer = ""
                parsed = lenient_json(answer)
                state = json.dumps(parsed, ensure_ascii=False) if parsed is not None else state
                votes.append(consensus_vote(answer))
            agreed = all(v == "FINAL" for v in votes)
        return pd.DataFrame({"batch": [int(frame["batch"].iloc[0])], "rounds": [rounds], "state": [state], "consensus": [agreed]})

    batches = units.withColumn("batch", F.floor(F.col("pos") / size).cast("long"))
    return batches.groupBy("batch").applyInPandas(run, "batch long, rounds int, state string, consensus boolean")


def call_in_batches(items: DataFrame, call: Call, default: str, batch: int = 20, retries: int = 2, one_by_one: bool = False) -> DataFrame:
    """(id, answer, answered, error) for items(id, payload): each batch is called until it answers all its ids, or retried out.

    An id that no batch answered is called alone once more if one_by_one is set; error tells what the last failed call said.
    """

    def run(batches):
        for frame in batches:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                answers: dict[str, str] = {}
                error = None
                for _ in range(retries + 1):
                    todo = part[~part["id"].isin(answers.keys())]
                    if todo.empty:
                        break
                    try:
                        answers |= {str(i): a for i, a in call(todo["payload"].tolist()) if str(i) in set(todo["id"])}
                    except Exception as e:  # noqa: BLE001 - a failed call is one without answers
                        error = str(e)[:1000]
                for i, payload in zip(part["id"], part["payload"]) if one_by_one else ():
                    if i not in answers:
                        try:
                            answers |= {str(k): a for k, a in call([payload]) if str(k) == i}
                        except Exception as e:  # noqa: BLE001
                            error = str(e)[:1000]
                there = [i in answers for i in part["id"]]
                errors = [None if known else error for known in there]
                yield pd.DataFrame({"id": part["id"], "answer": [answers.get(i, default) for i in part["id"]], "answered": there, "error": errors}, dtype=object)

    return items.select("id", "payload").mapInPandas(run, "id string, answer string, answered boolean, error string")


def lenient_json(text: str) -> dict | None:
    """The object in an answer: in its last fence, else in a fence left open, else in the answer itself."""
    fenced = _FENCE.findall(text)
    still_open = _OPEN_FENCE.search(text)
    for candidate in (fenced[-1] if fenced else None, still_open[1] if still_open and not fenced else None, text):
        if candidate is None:
            continue
        start = candidate.find("{")
        for form in (candidate[start:], candidate[start:].replace("\\'", "'")) if start >= 0 else ():
            try:
                found, _ = json.JSONDecoder().raw_decode(form)
            except ValueError:
                continue
            return found if isinstance(found, dict) else None
    return None


def consensus_vote(text: str) -> str | None:
    found = _VOTE.search(text)
    return found[1].upper() if found else None
