"""Scans, sinks, stage layout, record stores and fixture builders."""
from .tables import read_table  # noqa: F401
from .csv_io import scan_csv, sink_csv  # noqa: F401
from .stages import Stages  # noqa: F401
from .records import append_predictions, page, sink_predictions, PREDICTION_SCHEMA  # noqa: F401
from .registry import latest_model, load_latest_model, save_model_version  # noqa: F401
