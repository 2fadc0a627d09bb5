"""Prompt texts and batch completion with an injected client."""

from __future__ import annotations

import json
import operator
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import suppress
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larchfield.functions.text import literal_map, stripped

# A client turns one prompt into an answer: plain text or typed blocks as JSON.
Client = Callable[[str], str]

# What each severity means to a reader of the report.
SEVERITY_TEXT = {
    "warning (fix applied)": "The value was repaired while loading",
    "warning (missing file)": "The source file never arrived, so nothing was loaded from it",
    "error (quarantined)": "The rows were set apart and wait for somebody to look at them",
    "warning (passed to silver)": "The rows went on with a note attached",
}


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("None"))


def _facts(lines: dict[str, Column]) -> Column:
    """``name: value`` lines in the given order."""
    return F.concat_ws("\n", *(F.concat(F.lit(f"{n}: "), value) for n, value in lines.items()))


def dq_prompt(log: DataFrame, target: str = "prompt") -> DataFrame:
    """Ask for a plain-language explanation of each logged issue."""
    severity = F.coalesce(literal_map(SEVERITY_TEXT)[F.lower("severity")], _text("severity"))
    percent = F.when(F.col("affected_ratio").isNull(), "N/A").otherwise(
        F.concat(F.format_number(F.col("affected_ratio") * 100, 1), F.lit("%"))
    )
    facts = _facts(
        {
            "System": _text("table_name"),
            "Column": _text("column_name"),
            "Rule": _text("rule_name"),
            "What happened": _text("issue_description"),
            "What was done": severity,
            "Records": F.concat(_text("affected_records"), F.lit(" ("), percent, F.lit(")")),
            "Suggested fix": _text("suggested_fix"),
        }
    )
    ask = (
        "Explain this data quality issue to a compliance officer in plain business words, under"
        " the headings FINDING, BUSINESS IMPACT, ROOT CAUSE, ACTION TAKEN, PREVENTION.\n\n"
    )
    return log.withColumn(target, F.concat(F.lit(ask), facts))


def brief_prompt(scored: DataFrame, target: str = "prompt") -> DataFrame:
    """Ask for an investigation brief on each scored claim, with all its figures."""

    def amount(column: str) -> Column:
        return F.format_number(F.coalesce(F.col(column), F.lit(0.0)), 2)

    def rule(column: str) -> Column:
        if column not in scored.columns:
            return F.lit("0.000")
        return F.format_number(F.coalesce(F.col(column), F.lit(0.0)), 3)

    def known(column: str) -> Column:
        return _text(column) if column in scored.columns else F.lit("None")

    def or_unknown(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit("Unknown"))

    triggered = F.coalesce(F.nullif("triggered_rules", F.lit("")), F.lit("None"))
    facts = _facts(
        {
            "Claim": known("claimid"),
            "Customer": known("customer_id"),
            "Policy": known("policyid"),
            "Incident date": known("incident_date"),
            "Severity": known("incident_severity"),
            "Type": known("incident_type"),
            "Total claimed": amount("total_claim_amount"),
            "Vehicle part": amount("vehicle_claim"),
            "Property part": amount("property_claim"),
            "Injury part": amount("injury_claim"),
            "Processing days": known("claim_processing_days"),
            "Vehicles involved": known("number_of_vehicles_involved"),
            "Witnesses": known("witnesses"),
            "Authorities": known("authorities_contacted"),
            "Property damage": or_unknown("property_damage"),
            "Police report": or_unknown("police_report_available"),
            "Rejected": known("claim_rejected"),
            "Claims of this customer": known("customer_claim_count"),
            "Region": known("customer_region"),
            "Policy limits": known("policy_csl"),
            "Score": F.concat(F.format_number("anomaly_score", 1), F.lit(" / 100")),
            "Tier": known("priority_tier"),
            "Rules triggered": triggered,
            "R1 amount": rule("r1_amount_zscore"),
            "R2 severity": rule("r2_severity_mismatch"),
            "R3 injury ratio": rule("r3_injury_ratio"),
            "R4 staged": rule("r4_staged_accident"),
            "R5 documents": rule("r5_doc_gap"),
            "R6 theft": rule("r6_theft_with_injury"),
            "R7 ghost injury": rule("r7_ghost_injury"),
            "R8 per person": rule("r8_injury_per_person"),
        }
    )
    ask = (
        "Write an investigation brief of at most 400 words on this flagged insurance claim: why"
        " it is suspicious, which risk factors are present, and three to five next steps. Rely"
        " only on the figures below (rules run from 0, no signal, to 1).\n\n"
    )
    return scored.withColumn(target, F.concat(F.lit(ask), facts))


def facts_prompt(
    df: DataFrame, ask: str, columns: Sequence[str], target: str = "prompt"
) -> DataFrame:
    """A request followed by the row's figures, for one answer per aggregate row."""
    facts = _facts({name: _text(name) for name in columns})
    return df.withColumn(target, F.concat(F.lit(f"{ask}\n\n"), facts))


def insight_prompt(bundle: DataFrame, target: str = "prompt") -> DataFrame:
    """Ask for an executive summary of each KPI bundle row."""
    return bundle.withColumn(
        target,
        F.concat(
            F.lit("Write a short executive summary in three to five paragraphs.\nDomain: "),
            "domain",
            F.lit("\nKey figures (JSON): "),
            "kpi_json",
        ),
    )


def extract_text(answer: str | Column, mode: str = "all") -> Column:
    """Text of a completion given as plain text or as a JSON list of typed blocks.

    ``all`` joins the text blocks with spaces, ``first`` takes the first one.
    Reasoning and tool blocks are skipped; a list without text blocks is empty.
    Text that is not such a list is returned trimmed, NULL as empty text.
    """
    answer = F.col(answer) if isinstance(answer, str) else answer
    trimmed = stripped(answer)
    blocks = F.from_json(trimmed, "array<struct<type:string,text:string>>")
    texts = F.transform(
        F.filter(blocks, lambda b: b["type"] == "text"),
        lambda b: F.coalesce(b["text"], F.lit("")),
    )
    found = F.array_join(texts, " ") if mode == "all" else F.coalesce(F.get(texts, F.lit(0)), F.lit(""))
    is_list = trimmed.startswith("[") & blocks.isNotNull()
    return F.coalesce(stripped(F.when(is_list, found).otherwise(trimmed)), F.lit(""))


@dataclass(frozen=True)
class Patience:
    """How often and how slowly a failing call is tried again."""

    retries: int = 3
    wait: float = 2.0
    rate_limit_wait: float = 10.0
    delay: float = 0.0

    def ask(self, client: Client, text: str) -> tuple[str, str]:
        for attempt in range(self.retries + 1):
            if self.delay:
                time.sleep(self.delay)
            try:
                return client(text), "success"
            except Exception as error:  # noqa: BLE001 - any client error is recorded on the row
                message = str(error)
                limited = "429" in message or "REQUEST_LIMIT_EXCEEDED" in message
                if attempt < self.retries:
                    time.sleep(self.rate_limit_wait * 2 ** (attempt + 1) if limited else self.wait)
        return f"[LLM_ERROR after {self.retries + 1} attempts: {message}]", "error"


def complete(
    df: DataFrame,
    prompt: str,
    client_factory: Callable[[], Client],
    retries: int = 3,
    wait: float = 2.0,
    rate_limit_wait: float = 10.0,
    delay: float = 0.0,
    response: str = "response",
    status: str = "generation_status",
    log: str | None = None,
) -> DataFrame:
    """Send every prompt to a client and keep each row with its answer and status.

    ``client_factory`` runs once per task. A call that fails is tried ``retries``
    more times, with growing pauses after a rate-limit error; then the answer is
    an ``[LLM_ERROR ...]`` text and the status ``error``. The number of calls in
    flight is the number of running tasks: repartition ``df`` to limit it.

    With ``log``, a folder that all executors share, equal prompts are asked once,
    and an answer is stored as soon as it is there. A task that is lost, a second
    evaluation and a later run find it there and do not call again. Without it a
    lost task repeats its calls.
    """
    patience = Patience(retries, wait, rate_limit_wait, delay)
    if log is not None:
        return _answered(df, prompt, client_factory, patience, response, status, AnswerLog(log))
    schema = df.select(
        "*", F.lit("").alias(response), F.lit("").alias(status)
    ).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for frame in frames:
            answers = [patience.ask(client, text) for text in frame[prompt]]
            yield frame.assign(
                **{response: [a for a, _ in answers], status: [s for _, s in answers]}
            )

    return df.mapInPandas(run, schema)


@dataclass(frozen=True)
class AnswerLog:
    """Answers by the hash of their prompt, in a folder per bucket of hashes.

    Each answer is stored as a file of its own that appears under its name at once,
    so tasks need no agreement: two that race store the same name. Small files take
    a block of the disk each, so those of a bucket that is done go into one.
    """

    folder: str
    buckets: int = 1024

    def store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder if "://" in self.folder or self.folder.startswith("file:") else f"file://{self.folder}")

    def known(self, bucket: int) -> tuple[dict[str, str], dict[str, str]]:
        """Stored answers of one bucket by prompt hash: all, and those in a file of their own."""
        store, root = self.store()
        for last in (False,) * 20 + (True,):
            found = store.get_file_info(fs.FileSelector(f"{root}/{bucket}", allow_not_found=True))
            paths = [f.path for f in found]
            try:
                packs = [json.loads(self._read(store, p)) for p in paths if p.endswith(".json.gz")]
                single = {p.rpartition("/")[2].removesuffix(".txt"): self._read(store, p) for p in paths if p.endswith(".txt")}
            except FileNotFoundError:
                # Another task has just put them into one file, which the next look finds.
                if last:
                    raise
            else:
                return reduce(operator.or_, packs, {}) | single, single

    def _read(self, store: fs.FileSystem, path: str) -> str:
        with store.open_input_stream(path) as source:
            return source.read().decode()

    def _store(self, bucket: int, name: str, content: str) -> None:
        store, root = self.store()
        # Streams are compressed by the ending of the name.
        draft = f"{root}/{bucket}/{uuid.uuid4().hex}.draft{'.gz' * name.endswith('.gz')}"
        try:
            sink = store.open_output_stream(draft)
        except FileNotFoundError:
            store.create_dir(f"{root}/{bucket}", recursive=True)
            sink = store.open_output_stream(draft)
        with sink:
            sink.write(content.encode())
        store.move(draft, f"{root}/{bucket}/{name}")

    def keep(self, bucket: int, prompt_id: str, answer: str) -> None:
        self._store(bucket, f"{prompt_id}.txt", answer)

    def pack(self, bucket: int, answers: dict[str, str]) -> None:
        """Put answers that have a file each into one file."""
        if len(answers) < 2:
            return
        self._store(bucket, f"{uuid.uuid4().hex}.json.gz", json.dumps(answers))
        store, root = self.store()
        for prompt_id in answers:
            with suppress(FileNotFoundError):
                store.delete_file(f"{root}/{bucket}/{prompt_id}.txt")


def _answered(
    df: DataFrame,
    prompt: str,
    client_factory: Callable[[], Client],
    patience: Patience,
    response: str,
    status: str,
    log: AnswerLog,
) -> DataFrame:
    """``complete`` over distinct prompts, by way of the log."""
    keyed = df.withColumn("_prompt_id", F.sha2(F.col(prompt), 256))
    bucket = F.pmod(F.xxhash64("_prompt_id"), F.lit(log.buckets)).cast("int")
    asked = keyed.filter("_prompt_id IS NOT NULL").groupBy("_prompt_id").agg(F.first(prompt).alias("_prompt"))
    # A bucket lies in one task, which reads its stored answers once.
    dealt = asked.withColumn("_bucket", bucket).repartition("_bucket").sortWithinPartitions("_bucket")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, at, known, single = client_factory(), None, {}, {}
        for frame in frames:
            found = []
            for prompt_id, text, number in zip(frame["_prompt_id"], frame["_prompt"], frame["_bucket"], strict=True):
                if number != at:
                    log.pack(at, single)
                    at, (known, single) = number, log.known(number)
                if prompt_id in known:
                    found.append((known[prompt_id], "success"))
                    continue
                answer, outcome = patience.ask(client, text)
                if outcome == "success":
                    log.keep(number, prompt_id, answer)
                    single[prompt_id] = answer
                found.append((answer, outcome))
            yield pd.DataFrame(
                {"_prompt_id": frame["_prompt_id"], response: [a for a, _ in found], status: [s for _, s in found]}
            )
        log.pack(at, single)

    schema = f"_prompt_id string, `{response}` string, `{status}` string"
    return keyed.join(dealt.mapInPandas(run, schema), "_prompt_id", "left").drop("_prompt_id")
