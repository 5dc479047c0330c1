"""voltaic: fleet battery-telemetry analytics as Spark DataFrame operators.

The most used operators, importable from the package root::

    from voltaic import scan_readings, window_pivot, ml_dataset, split_by_rank, train_rf

Everything else lives in ``voltaic.sources``, ``voltaic.operators``,
``voltaic.streaming`` and ``voltaic.jobs``.
"""
from voltaic.operators.evaluate import auc, multiclass_metrics, threshold_sweep  # noqa: F401
from voltaic.operators.features import ml_dataset, ml_features, sequence_features  # noqa: F401
from voltaic.operators.model import feature_importance, score_rows, train_rf  # noqa: F401
from voltaic.operators.split import split_by_rank, split_by_time  # noqa: F401
from voltaic.operators.windows import window_pivot, window_wide  # noqa: F401
from voltaic.sources.readings import scan_readings  # noqa: F401

__version__ = "0.1.0"
