"""Texts that models and users see, and limits of an answer, stated in full."""

#: Prompt for a frame with annotated objects.
PROMPT_VISIBLE = """\
You are generating teacher Chain-of-Thought (CoT) data for a Vision-Language Navigation (VLN) agent.

Return exactly one compact JSON object and nothing else.
Required keys:
- step1_task_progress
- step2_spatial_perception
- step3_decision_logic
- step4_memory_update

Rules:
1. Use only the provided ground-truth state and the current image. Do not hallucinate.
2. Keep each text field concise: 1-2 sentences only.
3. Treat the Historical Trajectory Memory as the memory anchor carried from the previous frame. Use it as immediate past context instead of listing all past actions.
4. Write actual reasoning content, not meta-instructions or copied placeholders.
5. `step1_task_progress` must state the current instruction progress: which predefined sub-tasks are already done, which step/sub-task the agent is currently on, and which step should be executed right now.
6. `step2_spatial_perception` must cover every ground-truth annotated object visible in the current frame. Mention each object's exact name, exact bbox in `[xmin, ymin, xmax, ymax]`, relative screen position, and the key spatial relations among the objects when there are multiple.
7. `step3_decision_logic` must explain why the action '{next_action}' is correct right now by grounding the decision in the spatial evidence from `step2_spatial_perception`, including object positions, bounding boxes, relative relations, and visibility state when relevant.
8. `step4_memory_update` must be exactly one concise sentence that reuses the task-progress conclusion from `step1_task_progress` and records the current active task plus the action '{next_action}', so it can be reused as the next frame's Historical Trajectory Memory.
9. The final action label is already known, so do not add any extra action field beyond the four required reasoning keys.
10. Do not output Markdown, code fences, comments, or any extra keys.

[Current Ground-Truth State]:
- Global Instruction: "{global_instruction}"
- Pre-defined Sub-tasks: {global_subtasks_list}
- Previously Completed Sub-tasks: {completed_subtasks}
- Current Active Sub-task Index: {completed_index}
- Current Active Sub-task: "{current_subtask}"
- Historical Trajectory Memory: "{script_memory}"
- Target Landmark/Object in Current Frame: {target_object_name}
- Ground-Truth Target BBox (Normalized 0-1000): {bbox_norm}
- All Ground-Truth Annotated Objects in Current Frame (Normalized 0-1000): {annotated_objects}
- Ground-Truth Next Action: {next_action}

[Visual Input]:
<Image>

[Task Requirements]:
Based on the image and the ground-truth state, return a compact JSON object such as:
{{
  "step1_task_progress": "<actual concise reasoning here>",
  "step2_spatial_perception": "<actual concise reasoning here>",
  "step3_decision_logic": "<actual concise reasoning here>",
  "step4_memory_update": "<actual concise reasoning here>"
}}\
"""

#: Prompt for a frame without annotated objects.
PROMPT_UNSEEN = """\
You are generating teacher Chain-of-Thought (CoT) data for a Vision-Language Navigation (VLN) agent.

Return exactly one compact JSON object and nothing else.
Required keys:
- step1_task_progress
- step2_spatial_perception
- step3_decision_logic
- step4_memory_update

Rules:
1. Use only the provided ground-truth state and the current image. Do not hallucinate.
2. Keep each text field concise: 1-2 sentences only.
3. Treat the Historical Trajectory Memory as the memory anchor carried from the previous frame. Use it as immediate past context instead of listing all past actions.
4. Write actual reasoning content, not meta-instructions or copied placeholders.
5. `step1_task_progress` must state the current instruction progress: which predefined sub-tasks are already done, which step/sub-task the agent is currently on, and which step should be executed right now.
6. `step2_spatial_perception` must explicitly state that no ground-truth annotated object is visible in the current frame and must not invent any object or bounding box.
7. `step3_decision_logic` must explain why the action '{next_action}' is correct right now by grounding the decision in the spatial evidence from `step2_spatial_perception`, including object positions, bounding boxes, relative relations, and visibility state when relevant.
8. `step4_memory_update` must be exactly one concise sentence that reuses the task-progress conclusion from `step1_task_progress` and records the current active task plus the action '{next_action}', so it can be reused as the next frame's Historical Trajectory Memory.
9. The final action label is already known, so do not add any extra action field beyond the four required reasoning keys.
10. Do not output Markdown, code fences, comments, or any extra keys.

[Current Ground-Truth State]:
- Global Instruction: "{global_instruction}"
- Pre-defined Sub-tasks: {global_subtasks_list}
- Previously Completed Sub-tasks: {completed_subtasks}
- Current Active Sub-task Index: {completed_index}
- Current Active Sub-task: "{current_subtask}"
- Historical Trajectory Memory: "{script_memory}"
- All Ground-Truth Annotated Objects in Current Frame (Normalized 0-1000): []
- Target Landmark/Object: (Not visible in current frame)
- Ground-Truth Next Action: {next_action}

[Visual Input]:
<Image>

[Task Requirements]:
Based on the image and the ground-truth state, return a compact JSON object such as:
{{
  "step1_task_progress": "<actual concise reasoning here>",
  "step2_spatial_perception": "<actual concise reasoning here>",
  "step3_decision_logic": "<actual concise reasoning here>",
  "step4_memory_update": "<actual concise reasoning here>"
}}\
"""

#: System message of every request.
SYSTEM_PROMPT = """\
You are a careful VLN data generator.
Return only one compact JSON object with the requested keys.
Every field must be faithful to the provided ground-truth state.
Do not output Markdown or any explanatory text.
"""

#: The answer's fields, in order.
STEPS = (
    "step1_task_progress",
    "step2_spatial_perception",
    "step3_decision_logic",
    "step4_memory_update",
)
MAX_STEP_CHARS, MAX_TOTAL_CHARS, MAX_FEEDBACK_CHARS = 400, 1600, 4000
#: Phrases that say that nothing is to be seen.
UNSEEN_PHRASES = (
    "not visible",
    "not in view",
    "unseen",
    "no annotated object is visible",
    "no annotated objects are visible",
    "no object is visible",
    "no objects are visible",
)
#: What is told about an answer that failed, by reason code; {field} is the step at fault.
ERRORS = {
    "empty": "empty response",
    "json": "(): Invalid JSON",
    "object": "(): Input should be an object",
    "missing": "('{field}',): Field required",
    "type": "('{field}',): Input should be a valid string",
    "blank": "('{field}',): Value error, must not be empty",
    "long": "('{field}',): Value error, must be <= 400 chars",
    "extra": "(): Extra inputs are not permitted",
    "total": "(): Value error, reasoning text too long",
    "unseen": "(): Value error, step2 should describe a visible target, not say it is unseen",
    "label": "(): Value error, step2 must mention every visible annotated object name",
    "bbox": "(): Value error, step2 must include every visible annotated object's bbox",
    "visible": "(): Value error, step2 must say the target is not visible",
    "step3_action": "(): Value error, step3 must mention the chosen action",
    "step4_action": "(): Value error, step4 must mention the chosen action",
    "sentence": "(): Value error, step4 should be one concise sentence",
}
#: The same where the answer itself says more: where its JSON ends, and the first key too many.
ERROR_CAUSES = {
    "json": "(): Invalid JSON: {cause}",
    "extra": "({cause},): Extra inputs are not permitted",
}
#: Request after an answer that failed; {error} and {action} are filled in.
CORRECTION = (
    "Your previous JSON failed validation. Validation error: {error}. "
    "Return one corrected compact JSON object with exactly these keys: step1_task_progress, "
    "step2_spatial_perception, step3_decision_logic, step4_memory_update. "
    "Do not include any extra keys. Do not repeat prompt instructions or placeholder text. "
    "Step 2 must mention every visible annotated object with its bbox, or clearly say no "
    "annotated object is visible. Step 3 must clearly justify the action '{action}' using the "
    "spatial evidence from step2. Step 4 must update the current active task progress together "
    "with the chosen action."
)
#: The answer as a learner sees it.
ANSWER = (
    "**Reasoning Process:**\nStep 1: Task Progress. {step1}\nStep 2: Spatial Perception. {step2}\n"
    "Step 3: Decision Logic. {step3}\nStep 4: Memory Update. {step4}\n\n**Final Action:**\n{action}"
)
#: Sentences of the answer that is made from ground truth alone.
TRUTH_MEMORY = 'Using the previous memory anchor "{memory}",'
TRUTH_NO_MEMORY = "With no previous memory anchor,"
TRUTH_STEP1 = (
    "{clause} the agent has completed {done} of {total} sub-tasks and is now on step {step}: "
    "'{subtask}'. The step to execute now is this active sub-task."
)
TRUTH_STEP2 = "The annotated objects in this frame are {objects}."
TRUTH_STEP2_UNSEEN = (
    "The ground-truth annotated objects are not visible in the current frame, so there is no "
    "bbox to report."
)
TRUTH_LAYOUT = (
    "Based on the object positions, bounding boxes, and relative layout described in step2, the "
)
TRUTH_STEP3 = {
    "MOVE_FORWARD": "visible landmarks are already aligned with step {step} ('{subtask}'), so move "
    "forward is the correct action to keep progressing.",
    "TURN_LEFT": "scene still needs a leftward adjustment for step {step} ('{subtask}'), so turn "
    "left is the correct action right now.",
    "TURN_RIGHT": "scene still needs a rightward adjustment for step {step} ('{subtask}'), so turn "
    "right is the correct action right now.",
}
TRUTH_STEP3_OTHER = (
    "landmarks indicate that step {step} ('{subtask}') has been satisfied, so stop is the correct "
    "action now."
)
TRUTH_STEP3_UNSEEN_STOP = (
    "Based on the spatial evidence in step2, no annotated object is visible and there is no bbox "
    "to align to, so the trajectory indicates that stopping is the correct final action at this "
    "point."
)
TRUTH_STEP3_UNSEEN = (
    "Based on the spatial evidence in step2, no annotated object is visible for step {step} "
    "('{subtask}'), so {phrase} is the most reasonable action to continue it."
)
TRUTH_STEP4 = (
    "The agent is on step {step}: '{subtask}', and the action taken in this frame is {phrase}."
)
#: The memory that a frame hands on where no answer says it.
ANCHOR = "The agent is on '{subtask}', {seen}and the action taken is {phrase}."
ANCHOR_SUBTASK = "the current sub-task"
ANCHOR_SEEN = "sees {objects}, "
ANCHOR_UNSEEN = "no annotated object is visible, "
