"""DataFrame operators: filters, profiles, insights, features, models, evaluation."""
