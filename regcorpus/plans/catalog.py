"""Imports every plan module so that its queries register themselves."""

from __future__ import annotations

from regcorpus.plans import common
from regcorpus.plans import registers  # noqa: F401
from regcorpus.plans import cases  # noqa: F401
from regcorpus.plans import documents  # noqa: F401
from regcorpus.plans import links  # noqa: F401
from regcorpus.plans import rules  # noqa: F401
from regcorpus.plans import landing  # noqa: F401
from regcorpus.plans import extras  # noqa: F401
from regcorpus.plans import structure  # noqa: F401


def all_queries():
    return common.QUERIES


def all_oracles():
    return common.ORACLES


def bench_queries():
    return list(common.BENCH)
