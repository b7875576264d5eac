"""Generic DataFrame operators used by the models."""
