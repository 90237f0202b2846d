from lakelet.ml.model import ModelRegistry, present_predictions, score_batch, train_regressor

__all__ = ["ModelRegistry", "present_predictions", "score_batch", "train_regressor"]
