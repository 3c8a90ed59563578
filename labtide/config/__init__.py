"""Settings that a deployment supplies: laboratory identity, segments, output rules and column templates."""
