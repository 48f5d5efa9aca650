"""Reading resources into declared schemas, and writing results and change sets back."""
