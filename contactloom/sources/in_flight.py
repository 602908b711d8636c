"""Calls of outside services, several at once in a task.

A task's requests come one after another and so do their answers, in the same order; between the two a window of calls
runs.  Calls that are coroutines share one event loop, others run in threads of it.  No more requests are taken than
the window and a few answers that wait for their turn, so a slow service slows the reading down.
"""

from __future__ import annotations

import asyncio
import inspect
import threading
from collections import deque
from collections.abc import Awaitable, Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from typing import Any, TypeVar

T = TypeVar("T")
WAITING = 4  # answers that may wait for their turn, as a multiple of the calls at once


class Loop:
    """An event loop in a thread of its own, with ``at_once`` threads for calls that would hold it up."""

    def __init__(self, at_once: int) -> None:
        self.at_once = at_once
        self.loop = asyncio.new_event_loop()
        self.pool = ThreadPoolExecutor(at_once, thread_name_prefix="call")
        self.free = asyncio.Semaphore(at_once)
        threading.Thread(target=self.loop.run_forever, daemon=True).start()

    def start(self, work: Awaitable[T]) -> Future[T]:
        return asyncio.run_coroutine_threadsafe(work, self.loop)

    async def call(self, function: Callable, *arguments: Any) -> Any:
        """A plain function in a thread, a coroutine on the loop."""
        if inspect.iscoroutinefunction(function):
            return await function(*arguments)
        return await self.loop.run_in_executor(self.pool, function, *arguments)

    def close(self) -> None:
        """Calls that still run are given up."""
        def stop() -> None:
            for task in asyncio.all_tasks(self.loop):
                task.cancel()
            self.loop.call_soon(self.loop.stop)

        self.loop.call_soon_threadsafe(stop)
        self.pool.shutdown(wait=False, cancel_futures=True)


def in_order(requests: Iterator[dict], answer: Callable[[Loop, dict], Awaitable[dict]], at_once: int) -> Iterator[list[tuple[dict, dict]]]:
    """Groups of requests with their answers, in order: what is ready is handed on before anything is waited for.

    ``answer`` takes one of ``loop.free``'s places for as long as it calls, in the order of the requests.
    """
    loop, pending = Loop(at_once), deque()

    def ready(wait: bool) -> list[tuple[dict, dict]]:
        out = []
        while pending and (pending[0][1].done() or wait and not out):
            request, told = pending.popleft()
            out.append((request, told.result()))
        return out

    try:
        for request in requests:
            pending.append((request, loop.start(answer(loop, request))))
            if len(pending) >= WAITING * at_once:
                yield ready(wait=True)
        while pending:
            yield ready(wait=True)
    finally:
        loop.close()
