"""planlens: plan-versus-actual revenue analytics on Spark DataFrames."""
