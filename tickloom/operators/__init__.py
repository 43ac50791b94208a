"""DataFrame operators: decode/validate, normalise, batch, envelope, latest."""
