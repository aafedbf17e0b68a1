"""Part of inkwright; see the README."""
