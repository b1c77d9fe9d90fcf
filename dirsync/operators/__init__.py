"""Table operators: frames in, frames out, nothing read from the clock."""
