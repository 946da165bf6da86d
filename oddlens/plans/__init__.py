from oddlens.plans.eda import EdaBundle, eda_bundle
from oddlens.plans.modeling import ModelRun, run_model

__all__ = ["EdaBundle", "ModelRun", "eda_bundle", "run_model"]
