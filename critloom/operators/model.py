"""Batched model inference as an Arrow-batched column.

A *backend* maps a batch of message lists to a batch of strings of the same length and
order. The column runs it inside Spark tasks: rows arrive as Arrow batches, are cut into
chunks of ``backend.batch_size`` and passed to the backend. The backend object travels to
the workers by pickle; anything heavy (weights, clients) is loaded lazily in ``setup`` and
cached per Python worker, so it loads once per worker, not once per batch.

Failure rule: by default a failing chunk is retried row by row and only the failing rows
come back as ``""`` with an ``error``; ``blank_batch=True`` blanks the whole chunk instead
(what a failed call meant before rows were retried).
"""

from __future__ import annotations

import asyncio
import contextlib
import hashlib
import threading
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.prompts import Prompt
from ..functions.text import word_count
from ..schemas import GENERATED
from ..session import bound_batches, ship_package

_WORKER_CACHE: dict[str, object] = {}


class Backend:
    """Interface of a batch text model: implement ``generate_batch`` and, for weights or clients, ``setup``.

    ``setup`` runs once per Python worker and its result is reached through ``resource``.
    ``deterministic`` says that equal prompts always get equal replies; stages of other models
    are stored (see ``plans.generate``).
    """

    batch_size: int = 8
    deterministic: bool = False
    # Prompts of like length share a chunk, so that a model which pads its batches pads little. Replies
    # keep the order of the rows.
    by_length: bool = False

    def cache_key(self) -> str:
        """What a worker keeps the result of ``setup`` under: one key per backend object, kept when it is pickled."""
        if "_key" not in self.__dict__:
            self._key = f"{type(self).__qualname__}:{uuid.uuid4().hex}"
        return self._key

    def setup(self):  # pragma: no cover - real backends only
        """Load weights or open clients; called once per worker process."""
        return None

    def resource(self):
        return _resource(self)

    def generate_batch(self, messages_list: Sequence[list[dict]]) -> list[str]:
        raise NotImplementedError


def _joined(messages: Sequence[dict] | None) -> str:
    return "\x1f".join(f"{m.get('role') or ''}\x1e{m.get('content') or ''}" for m in (messages or []))


def stub_digest(messages: Sequence[dict] | None) -> str:
    """The deterministic stub reply: md5 of role/content pairs joined by control chars."""
    return hashlib.md5(_joined(messages).encode("utf-8")).hexdigest()


class StubModel(Backend):
    """Deterministic stand-in for a chat model; every reply is checkable in SQL."""

    batch_size = 4096
    deterministic = True

    def cache_key(self) -> str:
        return "stub-model"

    def generate_batch(self, messages_list):
        return [stub_digest(m) for m in messages_list]


class StubJudge(Backend):
    """Deterministic judge: a tagged score for 3 of 4 replies, an untagged number otherwise."""

    batch_size = 4096
    deterministic = True

    def cache_key(self) -> str:
        return "stub-judge"

    @staticmethod
    def reply(messages) -> str:
        h = stub_digest(messages)
        n = 1 + int(h[:8], 16) % 10
        if int(h[8:10], 16) % 4 == 0:
            return f"Assessment {h}. I would put this at {n} overall."
        return f"Assessment {h}.\nSCORE: {n}"

    def generate_batch(self, messages_list):
        return [self.reply(m) for m in messages_list]


class StubEchoModel(Backend):
    """Deterministic raw-completion model: echoes the prompt for about half the rows."""

    batch_size = 4096
    deterministic = True

    def cache_key(self) -> str:
        return "stub-echo"

    @staticmethod
    def reply(messages) -> str:
        h = stub_digest(messages)
        prompt = (messages[-1].get("content") or "") if messages else ""
        return f"{prompt}\n {h} " if int(h[0], 16) % 2 == 0 else h

    def generate_batch(self, messages_list):
        return [self.reply(m) for m in messages_list]


class StubVerdict(Backend):
    """Deterministic pairwise judge: answers ``A`` or ``B``."""

    batch_size = 4096
    deterministic = True

    def cache_key(self) -> str:
        return "stub-verdict"

    @staticmethod
    def reply(messages) -> str:
        h = stub_digest(messages)
        return f"Reasoning {h}. Answer: {'A' if int(h[:2], 16) % 2 == 0 else 'B'}"

    def generate_batch(self, messages_list):
        return [self.reply(m) for m in messages_list]


class FunctionBackend(Backend):
    """Wrap a plain function ``list[list[dict]] -> list[str]``."""

    def __init__(self, fn, batch_size: int = 8, deterministic: bool = False):
        self.fn, self.batch_size, self.deterministic = fn, batch_size, deterministic

    def generate_batch(self, messages_list):
        return self.fn(messages_list)


def _resource(backend: Backend):
    key = backend.cache_key()
    if key not in _WORKER_CACHE:
        _WORKER_CACHE[key] = backend.setup()
    return _WORKER_CACHE[key]


def _err(e: BaseException) -> str:
    return f"{type(e).__name__}: {e}"


def run_chunk(backend: Backend, rows: list, blank_batch: bool) -> list[tuple[str, str | None]]:
    """Call the backend on one chunk, applying the failure rule."""
    try:
        out = list(backend.generate_batch(rows))
        if len(out) != len(rows):
            raise ValueError(f"backend returned {len(out)} replies for {len(rows)} prompts")
        return [("" if o is None else str(o), None) for o in out]
    except Exception as e:  # noqa: BLE001 - the failure rule is the point
        if blank_batch or len(rows) == 1:
            return [("", _err(e))] * len(rows)
        return [r for row in rows for r in run_chunk(backend, [row], True)]


class AsyncBackend(Backend):
    """A model behind slow calls (a judge service): one call per row, some of them at once.

    Every task keeps a sliding window of at most ``in_flight`` calls: when one ends, the next row's
    starts, whatever the others do. A call that takes longer than ``time_limit`` seconds is given up, and one that
    fails for a passing reason is repeated after a pause that doubles each time. A row whose call
    fails for good has the text ``""`` and an error; the other rows are not touched. Implement
    ``reply`` as a coroutine, or use ``ThreadedBackend`` for a blocking client.
    """

    in_flight: int = 8
    time_limit: float = 60.0
    retries: int = 2
    backoff: float = 0.5  # seconds before the first repetition

    async def reply(self, messages: list[dict]) -> str:
        raise NotImplementedError

    def is_transient(self, error: Exception) -> bool:
        """Whether a failed call is worth repeating (default: connection errors)."""
        return isinstance(error, ConnectionError)

    def generate_batch(self, messages_list):
        texts, errors = run_window(self, list(messages_list))
        if failed := [e for e in errors if e]:
            raise RuntimeError(failed[0])
        return texts


class ThreadedBackend(AsyncBackend):
    """An ``AsyncBackend`` around a blocking client: implement ``call``. Calls run in threads of their own, as
    a stuck one cannot be ended: it is given up and its thread left behind."""

    def call(self, messages: list[dict]) -> str:
        raise NotImplementedError

    async def reply(self, messages):
        loop = asyncio.get_running_loop()
        done = loop.create_future()

        def settle(text, error):
            if not done.done():
                done.set_exception(error) if error is not None else done.set_result(text)

        def work():
            text = error = None
            try:
                text = self.call(messages)
            except Exception as e:  # noqa: BLE001 - handed to the caller
                error = e
            with contextlib.suppress(RuntimeError):  # given up, and the loop is closed
                loop.call_soon_threadsafe(settle, text, error)

        threading.Thread(target=work, daemon=True).start()
        return await done


class AsyncStubJudge(AsyncBackend):
    """The replies of ``StubJudge`` through the window."""

    deterministic = True

    def cache_key(self) -> str:
        return "async-stub-judge"

    async def reply(self, messages):
        await asyncio.sleep(0)
        return StubJudge.reply(messages)


async def _one_call(backend: AsyncBackend, messages: list[dict]) -> tuple[str, str | None]:
    for attempt in range(backend.retries + 1):
        task = asyncio.ensure_future(backend.reply(messages))
        done, _ = await asyncio.wait({task}, timeout=backend.time_limit)
        if not done:
            task.cancel()  # and not waited for: it may not listen
            return "", f"TimeoutError: no reply in {backend.time_limit:g} s"
        error = task.exception()
        if error is None:
            text = task.result()
            return "" if text is None else str(text), None
        if attempt == backend.retries or not backend.is_transient(error):
            return "", _err(error)
        await asyncio.sleep(backend.backoff * 2 ** attempt)
    raise AssertionError("not reached")


def run_window(backend: AsyncBackend, rows: list) -> tuple[list[str], list[str | None]]:
    """Replies and errors of a list of message lists, in its order, with at most ``in_flight`` calls at once."""
    found: list[tuple[str, str | None]] = [("", None)] * len(rows)
    waiting = iter(enumerate(rows))

    async def serve():
        for i, messages in waiting:  # shared: each taker gets the next row
            found[i] = await _one_call(backend, messages)

    async def window():
        await asyncio.gather(*[serve() for _ in range(min(max(1, backend.in_flight), len(rows)))])

    if "loop" not in _WORKER_CACHE:  # one per worker, as clients belong to the loop that they were made in
        _WORKER_CACHE["loop"] = asyncio.new_event_loop()
    _WORKER_CACHE["loop"].run_until_complete(window())
    return [t for t, _ in found], [e for _, e in found]


def _split_prompt(messages) -> tuple[list[dict], Column]:
    if isinstance(messages, Prompt):
        return [{"role": r, "content": c} for r, c in messages.prefix], messages.suffix
    return [], messages


def prompt_length(messages: Sequence[dict]) -> int:
    return sum(len(m.get("content") or "") for m in messages)


def _run_rows(backend: Backend, rows: list, prefix: list[dict], blank_batch: bool) -> tuple[list, list]:
    """Model replies (and errors) for a batch of message lists, in chunks of ``batch_size`` or by a window of calls."""
    size = max(1, int(backend.batch_size))
    full = [prefix + (r or []) for r in rows] if prefix else [r or [] for r in rows]
    if isinstance(backend, AsyncBackend):
        return run_window(backend, full)
    order = list(range(len(full)))
    if backend.by_length and len(full) > size:
        order.sort(key=lambda i: prompt_length(full[i]))
    texts: list[str] = [""] * len(full)
    errors: list[str | None] = [None] * len(full)
    for i in range(0, len(full), size):
        at = order[i:i + size]
        for k, (t, e) in zip(at, run_chunk(backend, [full[k] for k in at], blank_batch)):
            texts[k], errors[k] = t, e
    return texts, errors


def _generated_array(texts: list, errors: list) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(errors, pa.string())],
                                      names=["text", "error"])


def generate(messages, backend: Backend, blank_batch: bool = False) -> Column:
    """``struct<text, error>`` produced by the backend for each message list.

    ``messages`` is an ``array<struct<role,content>>`` column or a ``prompts.Prompt``; for a
    Prompt only the per-row suffix crosses into Python and the constant prefix (system
    prompt, few-shot examples) is prepended there, so it is not serialized once per row.
    """
    prefix, suffix = _split_prompt(messages)
    backend.cache_key()  # settled before the backend is pickled

    def _udf(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in it:
            yield _generated_array(*_run_rows(backend, arr.to_pylist(), prefix, blank_batch))

    ship_package()
    bound_batches()
    # Always non-deterministic for the optimizer: a model call is expensive and must run
    # exactly once per row and stage; a deterministic UDF may be inlined into several
    # consumers (e.g. the text and the error field) and evaluated more than once.
    fn = F.arrow_udf(_udf, GENERATED).asNondeterministic()
    return fn(suffix)


def generate_map(df, messages, name: str, backend: Backend, blank_batch: bool = False, profile=None):
    """U1 as a map stage: ``df`` plus column ``name`` (``struct<text, error>``).

    Same replies as ``generate``, computed with ``mapInArrow``, which can carry a Spark
    ``ResourceProfile``: with one, only the model stage is scheduled on executors with
    accelerators (stage-level scheduling) while scans and shuffles stay on the others.
    Whole rows pass through Python here, so keep ``df`` narrow before a map stage.
    """
    prefix, suffix = _split_prompt(messages)
    backend.cache_key()
    tmp = f"_prompt_{name}"
    src = df.withColumn(tmp, suffix)
    out_schema = T.StructType(list(src.schema.fields) + [T.StructField(name, GENERATED)])

    def _map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = _generated_array(*_run_rows(backend, b.column(tmp).to_pylist(), prefix, blank_batch))
            yield pa.RecordBatch.from_arrays(list(b.columns) + [out], names=list(b.schema.names) + [name])

    ship_package()
    bound_batches()
    mapped = src.mapInArrow(_map, out_schema, profile=profile) if profile is not None \
        else src.mapInArrow(_map, out_schema)
    return mapped.drop(tmp)


def generate_text(messages, backend: Backend, blank_batch: bool = False) -> Column:
    return generate(messages, backend, blank_batch).getField("text")


# ---- pluggable scalar scorer (reward model) -------------------------------------------

class Scorer:
    batch_size: int = 64
    deterministic: bool = False

    def score_batch(self, prompts: Sequence[str], responses: Sequence[str]) -> list[float]:
        raise NotImplementedError


class StubScorer(Scorer):
    """Deterministic reward in [0, 1): first 8 hex digits of md5(prompt, response)."""

    batch_size = 4096
    deterministic = True

    def score_batch(self, prompts, responses):
        return [int(hashlib.md5(f"{p or ''}\x1f{r or ''}".encode()).hexdigest()[:8], 16) / 4294967296.0
                for p, r in zip(prompts, responses)]


def score(prompt: Column, response: Column, scorer: Scorer) -> Column:
    """A reward column from a pluggable scorer, Arrow-batched."""
    size = max(1, int(scorer.batch_size))

    def _udf(it: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for p, r in it:
            ps, rs = p.to_pylist(), r.to_pylist()
            out: list[float] = []
            for i in range(0, len(ps), size):
                out.extend(scorer.score_batch(ps[i:i + size], rs[i:i + size]))
            yield pa.array(out, pa.float64())

    ship_package()
    bound_batches()
    fn = F.arrow_udf(_udf, T.DoubleType()).asNondeterministic()
    return fn(prompt, response)


# ---- pluggable token counter (F19) ----------------------------------------------------------

class TokenCounter:
    """Counts tokens of a batch of texts."""

    batch_size: int = 1024

    def count_batch(self, texts: Sequence[str | None]) -> list[int]:
        raise NotImplementedError


class CallableCounter(TokenCounter):
    """Wrap any tokenizer callable ``str -> list`` (e.g. a loaded ``tokenizers`` or
    ``tiktoken`` encoder's ``encode``); the encoder is pickled to the workers once."""

    def __init__(self, encode, batch_size: int = 1024):
        self.encode, self.batch_size = encode, batch_size

    def count_batch(self, texts):
        return [len(self.encode(t or "")) for t in texts]


class TokenSpans:
    """Start and end (in characters) of the tokens of a batch of texts."""

    batch_size: int = 256

    def spans_batch(self, texts: Sequence[str]) -> list[list[tuple[int, int]]]:
        raise NotImplementedError


def token_spans(text: Column, tokenizer: TokenSpans) -> Column:
    """``array<struct<s, e>>``, the places of a text's tokens by a pluggable tokenizer, Arrow-batched.
    A null text has no tokens."""
    size = max(1, int(tokenizer.batch_size))
    kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def _udf(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in it:
            ts = [t or "" for t in arr.to_pylist()]
            out: list = []
            for i in range(0, len(ts), size):
                out.extend([{"s": a, "e": b} for a, b in spans] for spans in tokenizer.spans_batch(ts[i:i + size]))
            yield pa.array(out, kind)

    ship_package()
    bound_batches()
    return F.arrow_udf(_udf, "array<struct<s:int,e:int>>")(text)


def token_count(text: Column, counter: TokenCounter | None = None) -> Column:
    """Token count of a text column: whitespace words as a built-in expression by default, else a
    pluggable counter, Arrow-batched."""
    if counter is None:
        return word_count(text).cast("bigint")
    size = max(1, int(counter.batch_size))

    def _udf(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in it:
            ts = arr.to_pylist()
            out: list[int] = []
            for i in range(0, len(ts), size):
                out.extend(counter.count_batch(ts[i:i + size]))
            yield pa.array(out, pa.int64())

    ship_package()
    bound_batches()
    return F.arrow_udf(_udf, T.LongType())(text)
