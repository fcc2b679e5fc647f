"""Whole-dataset plans (silver, gold, refresh) and the registered queries over the driver's tables."""
