"""Apply a caller's model to the rows of a table.

The model is a plain function made by a factory. The factory is called once per
task, in the Python worker, so weights or clients are loaded there and not pickled. Rows
travel in Arrow batches that Spark bounds by rows and by bytes
(``spark.sql.execution.arrow.maxRecordsPerBatch`` and ``maxBytesPerBatch``).
Inputs stay in their row beside the answer, so nothing has to be zipped back.

Prompts are rendered and answers are parsed by built-in expressions outside the worker.
Stage the result (``stage_table``) before using it twice: models are often not
deterministic and always the dearest step. Or name a ``log``: then each answer is written down as its
task ends, and a job that is started again asks only for what is missing (:mod:`.answerlog`).
"""

from __future__ import annotations

import sys
import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark import cloudpickle
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.functions.fixed_values import (
    CANDIDATES_PER_PROMPT,
    JUDGE_BATCH_SIZE,
    MAX_REQUESTS_IN_FLIGHT,
    STOP_STRINGS,
)
from prefspark.functions.prompts import (
    chat_messages,
    fill_judge_template,
    render_chatml,
    render_judge_prompt,
)
from prefspark.functions.scores import parse_score
from prefspark.functions.text import is_blank, py_strip, seeded_hash, text_digest
from prefspark.operators.answerlog import answered_from_log
from prefspark.sources.staging import stage_table

# Ship what this module sends to the workers by value, so that executors need no
# copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# Arrow batches of a task that may wait for their last remote answer; longest wait before a retry.
READ_AHEAD = 8
# Bytes of an Arrow batch that are turned into Python texts, and answered, at a time.
PIECE_BYTES = 4 << 20
# A request at more places than this has its verdict broadcast.
FREQUENT_REQUESTS = 100_000
MAX_BACKOFF = 60.0


@dataclass(frozen=True)
class GenerationSettings:
    """What a model is asked for. Passed to the factory as it is."""

    max_new_tokens: int = 2048
    temperature: float = 0.7
    top_p: float | None = None
    repetition_penalty: float | None = None
    answers: int = 1
    stop: tuple[str, ...] = ()
    # With a seed, every request goes to the model with a number of its own, made of this seed
    # and the request. It does not depend on tasks, batches or attempts.
    seed: int | None = None

    def __post_init__(self) -> None:
        if self.answers < 1:
            raise ValueError("answers must be at least 1")
        # A negative temperature means the same as zero: no sampling.
        object.__setattr__(self, "temperature", max(self.temperature, 0.0))

    @property
    def sampling(self) -> bool:
        return self.temperature > 0


# Fixed values of the five kinds of model step.
LOCAL_ANSWERS = GenerationSettings(max_new_tokens=2048, temperature=0.7)
REMOTE_ANSWERS = GenerationSettings(max_new_tokens=4096, temperature=0.7)
BATCH_ANSWERS = GenerationSettings(
    max_new_tokens=4096, temperature=0.6, top_p=0.9, repetition_penalty=1.05, stop=STOP_STRINGS
)
CANDIDATES = GenerationSettings(
    max_new_tokens=2048,
    temperature=0.7,
    top_p=0.9,
    answers=CANDIDATES_PER_PROMPT,
    stop=STOP_STRINGS,
)
JUDGEMENT = GenerationSettings(max_new_tokens=32, temperature=0.0)

# prompts -> for each prompt, its answers. A prompt is text, or a list of
# {role, content} dictionaries where chat messages are passed in. Where the settings have a seed,
# a second argument holds the seed of each prompt.
Model = Callable[..., Sequence[Sequence[str]]]
ModelFactory = Callable[[GenerationSettings], Model]
# one prompt (and its seed) -> one answer; may raise, and may return None for no text.
RemoteModel = Callable[..., str | None]
RemoteModelFactory = Callable[[GenerationSettings], RemoteModel]


def request_seed(seed: int, request: Column) -> Column:
    """A number below 2^28 from a seed and a request: text, or anything JSON can hold."""
    return F.conv(F.substring(seeded_hash(seed, request), 1, 7), 16, 10).cast("int")


def _run(
    df: DataFrame,
    prompt: Column,
    added: T.StructType,
    make_worker: Callable[[], Callable[[Iterator], Iterator]],
    settings: GenerationSettings,
    tasks: int,
    profile: ResourceProfile | None = None,
    log: str | None = None,
    seed: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Run a worker over the ``prompt`` column in so many tasks; its result columns are added to ``df``.

    The worker gets each Arrow batch in pieces, as (requests, seeds or None, whether the batch ends), and turns each
    into one list per added column, in order. It may read ahead. ``seed`` makes the seeds of a prompt column; null without a seed.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_types = [f.type for f in to_arrow_schema(added)]
    added_names = added.fieldNames()
    seeded = settings.seed is not None
    seed = seed or (lambda request: request_seed(settings.seed, as_text(df, request)))

    def ask(rows: DataFrame, request: Column) -> DataFrame:
        kept = len(rows.columns)
        schema = T.StructType([*rows.schema.fields, *added.fields])

        def run(batches):
            import pyarrow as pa

            waiting = deque()

            def requests():
                for batch in batches:
                    rows = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
                    for at in range(0, max(1, batch.num_rows), rows):
                        piece = batch.slice(at, rows)
                        waiting.append(piece)
                        yield piece.column(kept), piece.column(kept + 1) if seeded else None, at + rows >= batch.num_rows

            for values in make_worker()(requests()):
                batch = waiting.popleft()
                arrays = [pa.array(v, t) if not isinstance(v, pa.Array) else v for v, t in zip(values, arrow_types)]
                yield pa.RecordBatch.from_arrays(batch.columns[:kept] + arrays, names=batch.schema.names[:kept] + added_names)

        dealt = rows.repartition(tasks).withColumn("_prompt", request)
        if seeded:
            dealt = dealt.withColumn("_seed", seed(request))
        return dealt.mapInArrow(run, schema, profile=profile)

    if log is None:
        return ask(df, prompt)
    return answered_from_log(df, prompt, as_text(df, prompt), repr(settings), log, ask, added)


def as_text(df: DataFrame, request: Column) -> Column:
    """A request as text: itself, or as JSON where it is a list."""
    plain = isinstance(df.select(request).schema[0].dataType, T.StringType)
    return request if plain else F.to_json(request)


def _size(prompt: Any) -> int:
    if isinstance(prompt, str) or prompt is None:
        return len(prompt or "")
    return sum(len(m["content"] or "") for m in prompt)


def _each_row(shape: Callable[[list], list]):
    """How a piece with one request per row is taken apart, and its answers put back."""

    def take(prompts, seeds):
        return prompts.to_pylist(), None if seeds is None else seeds.to_pylist(), shape

    return take


def _lot_worker(factory: ModelFactory, settings: GenerationSettings, batch_size: int, take: Callable, read_ahead: int):
    """A worker that calls the model with lots of ``batch_size`` requests.

    ``take`` makes of a piece of an Arrow batch its requests, their seeds, and a function from answers to columns.
    A lot goes as soon as it is full, and what a batch has left over at its end, so that a task holds the Python
    texts of a piece and a lot and not of the batch.
    With ``read_ahead`` above 1, lots are filled from so many batches, and requests of
    like length share a lot, so that short ones do not wait for long ones. What does not fill a lot, the
    requests read last, goes with the batches that follow. Pieces leave in order.
    """
    if read_ahead < 1:
        raise ValueError("read_ahead must be at least 1")

    def make_worker():
        model = factory(settings)

        def ask(rows: list) -> None:
            if read_ahead > 1:
                rows = sorted(rows, key=lambda r: _size(r[2]))
            for start in range(0, len(rows), batch_size):
                lot = rows[start : start + batch_size]
                asked = [r[2] for r in lot]
                got = [list(a) for a in (model(asked) if settings.seed is None else model(asked, [r[3] for r in lot]))]
                if len(got) != len(lot) or any(len(a) != settings.answers for a in got):
                    raise ValueError(
                        f"the model must return {settings.answers} answer(s) for each of {len(lot)} prompts"
                    )
                for (piece, place, *_), answers in zip(lot, got):
                    piece[0][place] = answers
                    piece[1] -= 1

        def work(requests):
            pieces: deque = deque()  # [answers, how many are missing, what makes columns of them, whether a batch ends]
            waiting: list = []  # (piece, place in it, request, seed), as they came
            for prompts, seeds, ends in requests:
                flat, own, shape = take(prompts, seeds)
                piece = [[None] * len(flat), len(flat), shape, ends]
                pieces.append(piece)
                waiting += [(piece, k, p, own and own[k]) for k, p in enumerate(flat)]
                if read_ahead == 1 or ends and sum(p[3] for p in pieces) >= read_ahead:
                    full = len(waiting) if read_ahead == 1 and ends else len(waiting) // batch_size * batch_size
                    ask(waiting[:full])
                    del waiting[:full]
                while pieces and not pieces[0][1]:
                    answers, _, shape, _ = pieces.popleft()
                    yield shape(answers)
            ask(waiting)
            for answers, _, shape, _ in pieces:
                yield shape(answers)

        return work

    return make_worker


def _instructions(df: DataFrame, strip: bool) -> DataFrame:
    """Stripped, non-empty instructions, or all of them untouched."""
    if not strip:
        return df
    return df.withColumn("instruction", py_strip("instruction")).filter(F.col("instruction") != "")


def model_tasks(df: DataFrame) -> int:
    """Tasks of a model step when none are given: the session's slots or its shuffle partitions.

    A sample of a large table sits in few small partitions; without this one model would work
    while the others wait.
    """
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def generate_candidates(
    df: DataFrame,
    factory: ModelFactory,
    n: int | None = None,
    settings: GenerationSettings = CANDIDATES,
    prompt: Column | None = None,
    batch_size: int = JUDGE_BATCH_SIZE,
    partitions: int | None = None,
    profile: ResourceProfile | None = None,
    log: str | None = None,
    read_ahead: int = 1,
) -> DataFrame:
    """``(instruction, responses)`` with ``n`` stripped answers per non-empty instruction."""
    if n is not None:
        settings = replace(settings, answers=n)
    rows = _instructions(df.select("instruction"), strip=True)
    prompt = render_chatml("instruction") if prompt is None else prompt
    make_worker = _lot_worker(factory, settings, batch_size, _each_row(lambda answers: [answers]), read_ahead)
    added = T.StructType([T.StructField("responses", T.ArrayType(T.StringType()))])
    answered = _run(rows, prompt, added, make_worker, settings, partitions or model_tasks(df), profile, log)
    return answered.select("instruction", F.transform("responses", py_strip).alias("responses"))


def generate(
    df: DataFrame,
    factory: ModelFactory,
    settings: GenerationSettings = LOCAL_ANSWERS,
    prompt: Column | None = None,
    strip_input: bool = True,
    strip_output: bool = True,
    batch_size: int = JUDGE_BATCH_SIZE,
    partitions: int | None = None,
    profile: ResourceProfile | None = None,
    log: str | None = None,
    read_ahead: int = 1,
) -> DataFrame:
    """``(instruction, output)`` with one answer per instruction.

    ``strip_input`` strips instructions and leaves out empty ones; without it every
    row is answered as it is. ``prompt`` is what the model gets to see: text by
    default, or a :func:`chat_messages` column. ``partitions`` sets how many tasks call
    the model (:func:`model_tasks` by default), and ``profile`` which executors they run on.
    ``log`` names the answer log of the step; the model is then called at once, and only for
    requests that the log does not answer yet. ``read_ahead`` fills the lots of ``batch_size``
    requests from so many Arrow batches, by length; a task holds that many batches.
    """
    if settings.answers != 1:
        raise ValueError("generate asks for one answer; use generate_candidates for more")
    rows = _instructions(df.select("instruction"), strip_input)
    prompt = render_chatml("instruction") if prompt is None else prompt
    first = _each_row(lambda answers: [[a[0] for a in answers]])
    make_worker = _lot_worker(factory, settings, batch_size, first, read_ahead)
    added = T.StructType([T.StructField("output", T.StringType())])
    answered = _run(rows, prompt, added, make_worker, settings, partitions or model_tasks(df), profile, log)
    output = py_strip("output") if strip_output else F.col("output")
    return answered.select("instruction", output.alias("output"))


def _attempts(request: Callable, retries: int, backoff: float) -> Callable:
    """Ask once more after each failure, up to ``retries`` times, and wait twice as long each time."""

    def one(*asked):
        for attempt in range(retries + 1):
            if attempt:
                time.sleep(min(MAX_BACKOFF, backoff * 2 ** (attempt - 1)))
            try:
                return (request(*asked) or ""), None
            except Exception as e:  # noqa: BLE001 - any failure belongs to its row
                failure = f"{type(e).__name__}: {e}"
        return None, failure

    return one


def _window_worker(make_one: Callable[[], Callable], open_at_most: int, read_ahead: int):
    """A worker with a window of requests that goes on over the ends of batches.

    As soon as a request ends the next one starts, whichever batch it is in, so a slow one holds up
    nothing but its own slot. Batches leave in order; up to ``read_ahead`` of them wait for their last answer.
    """

    def make_worker():
        from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

        one = make_one()

        def work(requests):
            running: dict = {}  # future -> (outcomes of its piece, row)
            batches: deque = deque()  # pieces of them: [outcomes, how many are missing, whether the batch ends]

            def settle():
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    batch, row = running.pop(future)
                    batch[0][row] = future.result()
                    batch[1] -= 1

            def ready(room):
                while batches and (not batches[0][1] or sum(b[2] for b in batches) > room):
                    while batches[0][1]:
                        settle()
                    outcomes = batches.popleft()[0]
                    yield [[r[0] for r in outcomes], [r[1] for r in outcomes]]

            with ThreadPoolExecutor(open_at_most) as pool:
                for prompts, seeds, *ends in requests:
                    asked = list(zip(prompts.to_pylist(), *([] if seeds is None else [seeds.to_pylist()])))
                    batch = [[None] * len(asked), len(asked), all(ends)]
                    batches.append(batch)
                    for row, args in enumerate(asked):
                        while len(running) >= open_at_most:
                            settle()
                        running[pool.submit(one, *args)] = (batch, row)
                    yield from ready(read_ahead)
                yield from ready(0)

        return work

    return make_worker


def generate_remote(
    df: DataFrame,
    factory: RemoteModelFactory,
    settings: GenerationSettings = REMOTE_ANSWERS,
    prompt: Column | None = None,
    on_error: str = "drop",
    max_in_flight: int = MAX_REQUESTS_IN_FLIGHT,
    task_slots: int | None = None,
    retries: int = 0,
    backoff: float = 1.0,
    read_ahead: int = READ_AHEAD,
    log: str | None = None,
) -> DataFrame:
    """``(instruction, output)`` from a model that answers one request at a time.

    At most ``max_in_flight`` requests are open at once, however many tasks the cluster can run:
    the rows go to K tasks (``task_slots``, by default the cores of the session, and no more
    than requests), each with a window of ``max_in_flight // K`` requests that is refilled as
    requests end. Speculative execution would add to it. A task holds up to ``read_ahead`` Arrow batches
    while their slowest answers are out.

    A request that raises is tried up to ``retries`` times more, after ``backoff`` seconds, then twice as
    long, and so on; it keeps its place in the window while it waits. One that fails for good does not
    disturb the others. With ``drop`` its row is left out, with ``keep`` it stays with its last message in
    ``error`` and no output, with ``raise`` the query stops. An empty answer is an answer. In a ``log``,
    failures are not answers: a job that is started again asks for them again.
    """
    if on_error not in ("drop", "keep", "raise"):
        raise ValueError(f"on_error must be drop, keep or raise, not {on_error!r}")
    if max_in_flight < 1:
        raise ValueError("max_in_flight must be at least 1")
    if retries < 0 or backoff < 0 or read_ahead < 1:
        raise ValueError("retries and backoff must not be negative, read_ahead must be at least 1")
    tasks = min(max_in_flight, task_slots or df.sparkSession.sparkContext.defaultParallelism)
    rows = _instructions(df.select("instruction"), strip=True)
    prompt = render_chatml("instruction") if prompt is None else prompt
    make_worker = _window_worker(lambda: _attempts(factory(settings), retries, backoff), max_in_flight // tasks, read_ahead)
    added = T.StructType(
        [T.StructField("output", T.StringType()), T.StructField("error", T.StringType())]
    )
    answered = _run(rows, prompt, added, make_worker, settings, tasks, None, log)
    failed = F.col("error").isNotNull()
    if on_error == "drop":
        answered = answered.filter(~failed)
    elif on_error == "raise":
        answered = answered.filter(
            F.when(~failed, F.lit(True)).otherwise(F.raise_error(F.col("error")).cast("boolean"))
        )
    output = F.when(~failed, py_strip("output")).alias("output")
    return answered.select("instruction", output, *(["error"] if on_error == "keep" else []))


def judge(
    df: DataFrame,
    factory: ModelFactory,
    template: str,
    system: str,
    settings: GenerationSettings = JUDGEMENT,
    max_chars: int | None = None,
    as_messages: bool = False,
    parse: Callable[[Column], Column] = parse_score,
    batch_size: int = JUDGE_BATCH_SIZE,
    partitions: int | None = None,
    profile: ResourceProfile | None = None,
    log: str | None = None,
    read_ahead: int = 1,
    ask_once: bool = False,
) -> DataFrame:
    """``(instruction, responses, scores)`` with one score or null per response.

    A blank response is not sent to the judge and scores null, and so does an answer
    ``parse`` finds no number in. The row stays whole: its requests are lined up inside
    the Arrow batch, asked in lots of ``batch_size``, and its verdicts take the shape of
    its responses, so there is no explode and no join. Texts go whole unless ``max_chars`` cuts
    both. ``as_messages`` sends chat messages instead of text, for a judge with a chat
    layout of its own. In a ``log`` a row is one entry, with the verdicts on all its responses.

    ``ask_once`` sends equal requests of all rows once (:func:`_judge_once`); the judge then sees
    fewer requests, and the requests of a row are no longer asked together. With a ``log``, each
    request is an entry.
    """
    if settings.answers != 1:
        raise ValueError("a judge gives one answer per request")
    rows = df.select("instruction", "responses")

    def request(response: Column) -> Column:
        instruction = F.col("instruction")
        if as_messages:
            filled = fill_judge_template(instruction, response, template, max_chars)
            asked = chat_messages(filled, system)
        else:
            asked = render_judge_prompt(instruction, response, template, system, max_chars)
        return F.when(~is_blank(response), asked)

    tasks = partitions or model_tasks(df)
    if ask_once:
        first = _each_row(lambda answers: [[a[0] for a in answers]])
        make_worker = _lot_worker(factory, settings, batch_size, first, read_ahead)
        added = T.StructType([T.StructField("verdict", T.StringType())])
        judged = _judge_once(
            rows, request, lambda asked: _run(asked, F.col("request"), added, make_worker, settings, tasks, profile, log)
        )
        return judged.select(
            "instruction", "responses", F.transform("_verdicts", lambda v: parse(py_strip(v))).alias("scores")
        )

    def take(requests, seeds):
        import pyarrow as pa
        import pyarrow.compute as pc

        flat = requests.flatten()
        asked = pc.is_valid(flat)

        def shape(answers):
            each = iter(answers)
            texts = pa.array([next(each)[0] if a else None for a in asked.to_pylist()], pa.string())
            sizes = pc.fill_null(pc.list_value_length(requests), 0).to_pylist()
            offsets = [0]
            for size in sizes:
                offsets.append(offsets[-1] + size)
            return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), texts, mask=requests.is_null())]

        own = None if seeds is None else seeds.flatten().filter(asked).to_pylist()
        return flat.filter(asked).to_pylist(), own, shape

    make_worker = _lot_worker(factory, settings, batch_size, take, read_ahead)

    def seeds(requests: Column) -> Column:
        text = F.to_json if as_messages else lambda r: r
        return F.transform(requests, lambda r: request_seed(settings.seed, text(r)))

    added = T.StructType([T.StructField("_verdicts", T.ArrayType(T.StringType()))])
    judged = _run(rows, F.transform("responses", request), added, make_worker, settings, tasks, profile, log, seeds)
    return judged.select(
        "instruction", "responses", F.transform("_verdicts", lambda v: parse(py_strip(v))).alias("scores")
    )


def _judge_once(rows: DataFrame, request: Callable[[Column], Column], ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` with ``_verdicts``, where equal requests have been asked once.

    Rows are staged with a number. Requests meet by digest, combined in each task, so one that a third of all rows
    share is a row per task and one call. On the way back places, not texts, look their verdict up: requests that
    more than ``FREQUENT_REQUESTS`` places share are few, and are broadcast; the others are joined by digest.
    """
    numbered = stage_table(rows.withColumn("_row", F.monotonically_increasing_id()))
    asked = F.transform("responses", request)
    places = numbered.select("_row", F.posexplode(asked).alias("_place", "request"))
    text = as_text(places, F.col("request"))
    places = places.filter("request IS NOT NULL").withColumn("_digest", text_digest(text))
    distinct = places.groupBy("_digest").agg(F.any_value("request").alias("request"), F.count("*").alias("_times"))
    verdicts = stage_table(ask(distinct).select("_digest", "_times", "verdict"))
    # no more than the number of places over FREQUENT_REQUESTS
    frequent = F.broadcast(verdicts.filter(F.col("_times") > FREQUENT_REQUESTS).select("_digest", "verdict"))
    others = verdicts.filter(F.col("_times") <= FREQUENT_REQUESTS).select("_digest", "verdict")
    narrow = places.select("_row", "_place", "_digest")
    found = narrow.join(frequent, "_digest").unionByName(narrow.join(frequent, "_digest", "left_anti").join(others, "_digest"))
    per_row = found.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_place", "verdict"))).alias("_found"))
    joined = numbered.join(per_row, "_row", "left")
    looked_up = F.transform("responses", lambda r, k: F.try_element_at("_found", k))
    return joined.withColumn("_verdicts", looked_up)
