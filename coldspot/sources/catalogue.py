"""The input tables of the reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Catalogue:
    """The five input tables of the reports, lower-case columns.

    traces   : timeentryunix double, filename, eventtype, uuid string
               (``readers.read_traces`` gives these and ten more fields)
    contents : scope, name, child_name, did_type, child_type string
    dids     : created_at long (epoch ms), scope, name string, transient
    rses     : id, rse string
    dslocks  : rse_id, scope, name string, bytes long
    """

    traces: DataFrame
    contents: DataFrame
    dids: DataFrame
    rses: DataFrame
    dslocks: DataFrame
