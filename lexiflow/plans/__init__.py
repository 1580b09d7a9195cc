"""Compositions: splits, preparation, feature sets, experiments, tuning, jobs, registered queries."""
