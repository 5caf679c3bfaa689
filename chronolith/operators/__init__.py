"""DataFrame operators on bars, features, folds, models and expectations."""
