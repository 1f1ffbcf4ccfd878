"""Table operators: DataFrame in, DataFrame (or small fitted model) out."""
