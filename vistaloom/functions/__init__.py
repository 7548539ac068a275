"""Part of vistaloom."""
