from lakelet.store.feature_store import FeatureLookup, FeatureStore, TrainingSet

__all__ = ["FeatureLookup", "FeatureStore", "TrainingSet"]
