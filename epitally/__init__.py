"""epitally: case-counter analytics as small DataFrame-to-DataFrame functions."""
