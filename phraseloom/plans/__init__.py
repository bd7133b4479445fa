"""The pipelines composed of the operators."""
