"""Log analytics on Spark: strict decoding, filters, transforms, aggregates, ordered output."""

from tallyline.operators.aggregates import fold, fold_by_chunk, merge_partials
from tallyline.operators.batches import (
    chunk_sizes,
    gather_chunks,
    in_input_order,
    process_chunks,
    resequence,
    with_chunks,
)
from tallyline.operators.compare import difference, fingerprint, same_rows
from tallyline.operators.decode import decode_lines, is_malformed
from tallyline.operators.policy import (
    FAIL_FAST,
    SKIP,
    MalformedLineError,
    apply_policy,
    dead_letters,
    fail_fast,
    records,
    skip_malformed,
)
from tallyline.operators.predicates import build_predicate
from tallyline.operators.preview import every_nth, infer_types
from tallyline.operators.transforms import filter_then_transform
from tallyline.plans.run import RunOptions, RunResult, run_pipeline
from tallyline.plans.summary import append_history, run_totals, summarise, unreconciled
from tallyline.sinks.lines import write_lines, write_lines_per_file
from tallyline.sinks.reports import write_dead_letters, write_summary
from tallyline.sources.lines import read_lines, with_line_numbers
from tallyline.sources.tables import as_records, read_jsonl, read_parquet
from tallyline.streaming.ingest import ingest, ingest_lines

__all__ = [name for name in dir() if not name.startswith("_")]
