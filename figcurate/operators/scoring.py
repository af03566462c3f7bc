"""Models as plug-ins: scorers run on Arrow batches, request backends run with fault isolation.

A *scorer* takes a list of inputs and returns a list of equally many scores.  A *backend* takes a list of rows and returns
answers by request id.  Both are made in the worker by a factory, once per task, so models never travel with the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Scorer(Protocol):
    def __call__(self, inputs: list[Any]) -> list[float | None]: ...


#: Asks a list of (request_id, prompt, image_paths) rows at once; gives what it knows by request id: text, finish_reason and
#: generate_token_len, or error.
Backend = Callable[[list[dict[str, Any]], int | None], dict[str, dict[str, Any]]]


def with_scores(
    df: DataFrame, input_col: str, factory: Callable[[], Scorer], batch_size: int = 256, score: str = "score", error: str = "score_error"
) -> DataFrame:
    """``df`` with a float score per row; an input on which the scorer fails gets a null score and the error's text.

    A failing batch is scored again row by row, so one bad input does not take others with it.  Null inputs get a null score
    without an error.
    """

    @F.pandas_udf("struct<score: float, error: string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = factory()
        for series in batches:
            scores: list[float | None] = [None] * len(series)
            errors = [""] * len(series)
            at = [i for i, v in enumerate(series) if v is not None]
            for k in range(0, len(at), batch_size):
                part = at[k : k + batch_size]
                inputs = [series.iloc[i] for i in part]
                try:
                    found = list(scorer(inputs))
                    if len(found) != len(inputs):
                        raise ValueError(f"{len(found)} scores for {len(inputs)} inputs")
                    for i, s in zip(part, found, strict=True):
                        scores[i] = s
                except Exception:
                    for i, value in zip(part, inputs, strict=True):
                        try:
                            scores[i] = scorer([value])[0]
                        except Exception as e:
                            errors[i] = f"{type(e).__name__}: {e}"
            yield pd.DataFrame({"score": pd.array(scores, dtype="Float32"), "error": errors})

    scored = df.withColumn("_scored", run(F.col(input_col)))
    return scored.withColumns({score: F.col("_scored.score"), error: F.col("_scored.error")}).drop("_scored")


def answers(backend: Backend, rows: list[dict[str, Any]], max_new_tokens: int | None = None) -> dict[str, dict[str, Any]]:
    """What the backend gives for every row, by request id.

    Rows are asked together; those that a call leaves out are asked again by themselves, one at a time, so what fails takes no
    other with it and what was answered is not asked twice.  A row that fails alone has only an error.
    """
    found: dict[str, dict[str, Any]] = {}
    work = [rows] if rows else []
    while work:
        part = work.pop()
        problem = ""
        try:
            given = backend(part, max_new_tokens)
            found |= {row["request_id"]: given[row["request_id"]] for row in part if row["request_id"] in given}
        except Exception as e:
            problem = f"{type(e).__name__}: {e}"
        left = [row for row in part if row["request_id"] not in found]
        if len(part) > 1:
            work += [[row] for row in left]
        elif left:
            found[left[0]["request_id"]] = {"error": problem or f"LookupError: no result for {left[0]['request_id']}"}
    return found


def per_request(answer: Callable[[str, list[str]], str]) -> Backend:
    """A backend from a function of prompt and image paths; an exception is that request's error."""

    def one(row: dict[str, Any]) -> dict[str, Any]:
        try:
            return {"text": answer(row["prompt"], row["image_paths"])}
        except Exception as e:
            return {"error": f"{type(e).__name__}: {e}"}

    return lambda rows, max_new_tokens: {row["request_id"]: one(row) for row in rows}


RESULT_SCHEMA = (
    "request_id string, text string, error string, finish_reason string, generate_token_len bigint, max_new_tokens bigint, "
    "attempts int, initial_finish_reason string, initial_token_len bigint"
)


def with_predictions(
    requests: DataFrame, factory: Callable[[], Backend], batch_size: int = 4, max_new_tokens: int | None = None,
    retry_tokens: int | None = None,
) -> DataFrame:
    """Results of (request_id, prompt, image_paths) requests.

    With ``retry_tokens``, requests that ended at their token limit are asked once more with that limit; the first attempt's
    finish reason and length are kept beside the second's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = factory()
        for batch in batches:
            rows = [{**r, "prompt": r["prompt"] or "", "image_paths": r["image_paths"] or []} for r in batch.to_pylist()]
            first: dict[str, dict[str, Any]] = {}
            again: dict[str, dict[str, Any]] = {}
            for k in range(0, len(rows), batch_size):
                part = rows[k : k + batch_size]
                got = answers(backend, part, max_new_tokens)
                first |= got
                if retry_tokens:
                    cut = [r for r in part if got[r["request_id"]].get("finish_reason") == "length"]
                    again |= answers(backend, cut, retry_tokens)
            yield pa.RecordBatch.from_pylist([_row(r["request_id"], first, again, max_new_tokens, retry_tokens) for r in rows], schema=_ARROW)

    return requests.select("request_id", "prompt", "image_paths").mapInArrow(run, RESULT_SCHEMA)


def _row(name: str, first: dict, again: dict, limit: int | None, retry_limit: int | None) -> dict[str, Any]:
    """The last answer to a request beside the facts of the first."""
    last, asked_again = again.get(name, first[name]), name in again
    return {
        "request_id": name, "text": last.get("text", ""), "error": last.get("error", ""), "finish_reason": last.get("finish_reason"),
        "generate_token_len": last.get("generate_token_len"), "max_new_tokens": retry_limit if asked_again else limit,
        "attempts": 1 + asked_again, "initial_finish_reason": first[name].get("finish_reason"),
        "initial_token_len": first[name].get("generate_token_len"),
    }


_ARROW = pa.schema(
    [
        ("request_id", pa.string()), ("text", pa.string()), ("error", pa.string()), ("finish_reason", pa.string()),
        ("generate_token_len", pa.int64()), ("max_new_tokens", pa.int64()), ("attempts", pa.int32()),
        ("initial_finish_reason", pa.string()), ("initial_token_len", pa.int64()),
    ]
)
