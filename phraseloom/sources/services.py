"""Boundaries to outside services: batches of model requests, downloads. The engine prepares and reads their data; what does the
call is injected. (UD16-UD20, SRC18)"""

from __future__ import annotations

import time
from collections.abc import Callable
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phraseloom.operators.windows import running_number

FINAL = ("completed", "failed", "expired", "cancelled")


class BatchService(Protocol):
    """What a batch service must offer."""

    def submit(self, request_file: str, metadata: dict[str, str]) -> str: ...

    def status(self, batch_id: str) -> str: ...

    def download(self, batch_id: str, target: str) -> str: ...

    def cancel(self, batch_id: str) -> None: ...

    def list(self, limit: int) -> list[dict]: ...


def submit(service: BatchService, request_file: str, metadata: dict[str, str]) -> dict[str, str]:
    """(UD16, UD19)"""
    return {"batch_id": service.submit(request_file, metadata), **metadata}


def batched(requests: DataFrame, order: list[str], size: int) -> DataFrame:
    """``requests`` with ``batch``: numbers of batches of at most ``size`` requests in the order, as a service limits them (UD16)."""
    return running_number(requests, order, "batch", 0).withColumn("batch", F.floor(F.col("batch") / size))


def completed(results: DataFrame, statuses: DataFrame) -> DataFrame:
    """Results of batches that ``statuses`` (batch, status) calls completed; others are not looked at (UD17, UD18)."""
    return results.join(statuses.where(F.col("status") == "completed").select("batch"), "batch", "left_semi")


def poll(service: BatchService, batch_id: str, every: float = 30, most: float = 3600, sleep: Callable[[float], None] = time.sleep) -> str:
    """Status until it is final or the time is up (UD17, UD20)."""
    waited = 0.0
    while (status := service.status(batch_id)) not in FINAL and waited < most:
        sleep(every)
        waited += every
    return status


def download(service: BatchService, batch_id: str, target: str) -> str:
    """Only of a completed batch (UD18)."""
    if (status := service.status(batch_id)) != "completed":
        raise RuntimeError(f"batch {batch_id} is {status}")
    return service.download(batch_id, target)


def fetch_once(target: str, fetch: Callable[[str], None]) -> str:
    """Download a dump unless it is there (SRC18)."""
    if not Path(target).exists():
        fetch(target)
    return target
