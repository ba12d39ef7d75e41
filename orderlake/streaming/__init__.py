"""Structured Streaming jobs: ingest (C1, T1–T2), the gate (T3), incremental layers and reports."""

from .gate import GATED_SCHEMA, gate_by_lane, with_lanes
from .incremental import bound_checkpoint, consume_landing, run_gold, run_silver
from .ingest import (LANDING_SCHEMA, close_flush, flush_ledger, gated_batch_handler, ingest, landed, landed_orders,
                     landed_rejects, parse_orders, quarantine, read_flushed, start_gated_ingest,
                     start_ingest, start_ingest_with_quarantine, to_wire)
from .layers import consume_flushes, consume_layer, read_consumed, register_consumed
from .reports import consume_reports, partial_sums, run_reports, stored_qty_by_event_time, stored_qty_by_neighborhood

__all__ = ["GATED_SCHEMA", "gate_by_lane", "with_lanes", "bound_checkpoint", "consume_landing", "run_gold", "run_silver", "LANDING_SCHEMA",
           "close_flush", "flush_ledger", "gated_batch_handler", "ingest", "landed", "landed_orders", "landed_rejects", "parse_orders",
           "quarantine", "read_flushed", "start_gated_ingest", "start_ingest", "start_ingest_with_quarantine", "to_wire",
           "consume_flushes", "consume_layer", "read_consumed", "register_consumed", "consume_reports", "partial_sums", "run_reports",
           "stored_qty_by_event_time", "stored_qty_by_neighborhood"]
