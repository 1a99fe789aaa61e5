"""The models and the questions built from the operators."""
