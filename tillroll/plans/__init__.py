from tillroll.plans.build import build_all, run_daily, run_pipeline
from tillroll.plans.incremental import load_receipts, loaded_models
from tillroll.plans.pipeline import MODEL_NAMES, SERVED_BY, STATE_NAMES, ReceiptModels

__all__ = ["MODEL_NAMES", "SERVED_BY", "STATE_NAMES", "ReceiptModels", "build_all", "load_receipts", "loaded_models", "run_daily", "run_pipeline"]
