"""Text-claims analytics as Spark jobs: cleaning, features, models, retrieval."""
