"""Reading frames, checking and cleaning them, and questionnaire labels."""
