"""Declared schemas of the data model. Reading with them fails early on drift."""

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
CONVERSATION = T.ArrayType(MESSAGE)

PAIR = T.StructType(
    [T.StructField("user", T.StringType()), T.StructField("bot", T.StringType())]
)
HISTORY = T.ArrayType(PAIR)

MODERATION = T.ArrayType(
    T.StructType(
        [
            T.StructField("flagged", T.BooleanType()),
            T.StructField("categories", T.MapType(T.StringType(), T.BooleanType())),
        ]
    )
)

SINGLE_TURN = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("adversarial", T.BooleanType()),
        T.StructField("response", T.StringType()),
        T.StructField("prompt_harm_label", T.StringType()),
        T.StructField("response_harm_label", T.StringType()),
        T.StructField("response_refusal_label", T.StringType()),
        T.StructField("subcategory", T.StringType()),
    ]
)

MULTI_TURN = T.StructType(
    [
        T.StructField("conversation_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("conversation", CONVERSATION),
        T.StructField("turn", T.IntegerType()),
        T.StructField("language", T.StringType()),
        T.StructField("openai_moderation", MODERATION),
        T.StructField("redacted", T.BooleanType()),
    ]
)

ATTACK_DIALOGUE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("scene", T.StringType()),
        T.StructField("history", HISTORY),
    ]
)

NAMES = T.StructType(
    [
        T.StructField("Id", T.LongType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("Count", T.LongType()),
    ]
)

SPLIT_FEATURES = T.StructType(
    [
        T.StructField("conversation_id", T.LongType()),
        T.StructField("conversation", T.StringType()),
        T.StructField("conversation_proc", T.StringType()),
    ]
)

SPLIT_LABELS = T.StructType(
    [T.StructField("conversation_id", T.LongType()), T.StructField("harm", T.IntegerType())]
)

EMBEDDINGS = T.StructType(
    [
        T.StructField("conversation_id", T.LongType()),
        T.StructField("encoder", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)
