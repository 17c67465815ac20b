"""Catalog price modelling on Spark: text features, profiles, models, ensembles."""
